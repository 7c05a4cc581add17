from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hirelake import vocab
from hirelake.functions.money import safe_decimal, salary_max, salary_min
from hirelake.functions.text import (
    clean_text,
    distinct_words,
    extract_or_null,
    role_casing,
    role_matches,
    role_words,
    split_words,
    strip_punctuation,
    work_type_normalised,
)
from hirelake.functions.times import parse_time, parse_time_lenient, publish_time, render_time


def apply(spark, values, *functions):
    """Rows of the functions' results for a string column of ``values``."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    out = df.orderBy("i").select(*[f(F.col("c")) for f in functions]).collect()
    return [r[0] if len(functions) == 1 else tuple(r) for r in out]


SALARIES = {
    "Rp 5,000,000 – Rp 8,000,000 per month": (5000000, 8000000),
    "Rp 5.000.000": (5000000, None),
    "$5,000.50 - $6,000 p.m.": (500050, 6000),
    "5–8 (13-month)": (5, None),
    "– 7": (None, 7),
    "": (None, None),
    None: (None, None),
    "9" * 40: (None, None),
}


def test_salary_bounds(spark):
    got = apply(spark, list(SALARIES), salary_min, salary_max)
    want = [tuple(None if x is None else Decimal(x) for x in pair) for pair in SALARIES.values()]
    assert got == want


def test_safe_decimal(spark):
    assert apply(spark, ["12", "x", ""], safe_decimal) == [Decimal(12), None, None]


def test_role_casing(spark):
    got = apply(spark, ["DATA ENGINEERING lead", "sr data engineer", "Analyst", None], role_casing)
    assert got == ["Data EngineerING lead", "sr Data Engineer", "Analyst", None]


def test_work_type(spark):
    got = apply(spark, ["Kontrak; FULL time", "Kontrak", "", None], work_type_normalised)
    assert got == [vocab.CONTRACT_WORK_TYPE, "Kontrak", vocab.NO_WORK_TYPE, vocab.NO_WORK_TYPE]


def test_clean_text_strips_all_whitespace(spark):
    assert apply(spark, ["\t a b \n", " x\x0b", " ", None], clean_text) == [
        "a b", "x", "", None,
    ]


def test_words(spark):
    text = "a  b\nc"
    assert apply(spark, [text], split_words) == [["a", "", "b\nc"]]
    assert apply(spark, ["C++, é-x\x0b K"], strip_punctuation) == ["C x "]
    # The Kelvin sign's lower case is an ASCII k: it must be gone before that.
    assert apply(spark, ["SQL sql K Sql, x"], distinct_words) == [["sql", "", "x"]]


def test_role_words_are_unicode(spark):
    assert apply(spark, ["Ingénieur data engineer"], role_words) == [["ingénieur", "data", "engineer"]]


def test_role_matches(spark):
    roles = ["Data Engineer", "Data data", "Data Lake", "Big-Data", "sql_data big", None]
    got = apply(spark, roles, role_matches)
    assert got == [True, False, False, True, False, None]


def test_extract_or_null(spark):
    assert apply(spark, ["a1", "b"], lambda c: extract_or_null(c, r"(\d)")) == ["1", None]


NOW = "2025-07-18 12:00:00"
AGES = {
    "5m ago": "2025-07-18 11:55:00",
    "3h ago": "2025-07-18 09:00:00",
    "30d+ ago": "2025-06-18 12:00:00",
    "Just now": NOW,
    "7": NOW,
    "5 hari": "2025-07-18 07:00:00",
    "2 jam": "2025-07-18 11:58:00",
    "999999999d ago": NOW,
    "99999999999999m": NOW,
    None: NOW,
}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta"])
def test_publish_time(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = F.lit(NOW).cast("timestamp_ntz")
        got = apply(spark, list(AGES), lambda c: render_time(publish_time(c, now)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == list(AGES.values())


@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta"])
def test_lenient_time(spark, zone):
    times = {
        "2025-07-18 12:00:00": datetime(2025, 7, 18, 12),
        "2025-07-18T12:00:00Z": datetime(2025, 7, 18, 12),
        "2025-07-18 12:00:00+07:00": datetime(2025, 7, 18, 5),
        " 2025-07-18": datetime(2025, 7, 18),
        "2025-13-01 00:00:00": None,
        "bad": None,
        "": None,
        None: None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert apply(spark, list(times), parse_time_lenient) == list(times.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_time(spark):
    got = apply(spark, [" 2025-07-18 01:02:03 ", None], lambda c: parse_time(c, vocab.NO_TIME))
    assert got == [datetime(2025, 7, 18, 1, 2, 3), datetime(1900, 1, 1)]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        apply(spark, ["bad"], parse_time)


def test_age_of_an_instant_is_utc_in_any_session_zone(spark):
    from hirelake.functions.times import publish_time, render_time

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Jakarta"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = F.timestamp_seconds(F.lit(1752840000))  # 2025-07-18 12:00:00 UTC
            got = spark.range(1).select(render_time(publish_time(F.lit("3h ago"), at))).first()[0]
            assert got == "2025-07-18 09:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_long_character_references(spark):
    from hirelake.functions.markup import decode_entities

    df = spark.createDataFrame([("&#000000065;&#x0000000042;&#99999999999999999999;&#x0;",)], "t string")
    assert df.select(decode_entities(F.col("t"))).first()[0] == "AB\ufffd\ufffd"
