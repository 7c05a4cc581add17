"""Run a query and its DuckDB twin and compare the rows."""

import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def bag(columns, rows) -> tuple[list[str], Counter]:
    """Column names in order, and the rows as a multiset."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_norm(r[i]) for i in order) for r in rows
    )


def compare(df, con, sql: str) -> tuple[int, list, list]:
    """Row count, and examples of rows on one side only."""
    cur = con.execute(sql)
    want = bag([d[0] for d in cur.description], cur.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0], (got[0], want[0])
    return (
        sum(got[1].values()),
        list((got[1] - want[1]).items())[:2],
        list((want[1] - got[1]).items())[:2],
    )
