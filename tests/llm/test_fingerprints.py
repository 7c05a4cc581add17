"""Fingerprints against a Python version."""

import hashlib

import pytest
from pyspark.sql import functions as F

from hirelake.llm.fingerprints import containment, fingerprint_documents, likeness, merge, sketch


def edited(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        out[i] = (len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest())
    return out


def check(df, rows):
    want = edited(rows)
    got = fingerprint_documents(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256) == want[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    return {r.doc_id: r for r in got}


def test_given_documents(given):
    df, rows = given("documents")
    got = check(df, [r[:2] for r in rows])
    by_text = {}
    for i, text, *_ in rows:
        by_text.setdefault(text, set()).add(got[i].fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())
    long = [r.near_edited for r in got.values() if r.n_chars > 2000]
    assert 0.2 < sum(long) / len(long) < 0.5  # half of the shingles, of one and a half


def test_awkward_rows(documents, awkward):
    ids = [i * 1000 - 3000 for i in range(len(awkward))]  # blocks with gaps, negative ids
    got = check(documents(awkward, ids), list(zip(ids, awkward, strict=True)))
    assert got[ids[0]].fingerprint == got[ids[1]].fingerprint == ""
    assert got[ids[6]].fingerprint == got[ids[7]].fingerprint != ""


def test_single_row_follows_itself(documents):
    got = check(documents(["a b c d e f g"], [9]), [(9, "a b c d e f g")])
    assert got[9].near_next == 1


def test_rows_without_id_and_empty_table(documents):
    rows = fingerprint_documents(documents(["a b c d", "x y"], [None, 4])).collect()
    alone = next(r for r in rows if r.doc_id is None)
    assert alone.near_next is None and alone.edited_sha256 == hashlib.sha256(b"a b ").hexdigest()
    assert fingerprint_documents(documents([])).count() == 0


def test_merge_and_unequal_documents(spark):
    words = [f"w{i}" for i in range(9000)]
    df = spark.createDataFrame(
        [(" ".join(words[:8000]), " ".join(words[4000:4100]), " ".join(words[8000:]))], "a string, b string, c string"
    )
    s = {c: sketch(F.col(c)) for c in "abc"}
    whole = sketch(F.concat_ws(" ", "a", "c"))
    row = df.select(
        containment(s["b"], s["a"]).alias("inside"),
        likeness(s["a"], s["b"]).alias("like"),
        likeness(s["a"], s["c"]).alias("none"),
        containment(s["a"], merge(s["a"], s["c"])).alias("merged"),
        likeness(merge(s["a"], s["c"]), whole).alias("same"),
    ).first()
    assert row.inside == pytest.approx(1, abs=0.2)
    assert row.like < 0.05 and row.none == 0
    assert row.merged == 1 and row.same > 0.97


def test_no_python_in_the_plan(given):
    plan = fingerprint_documents(given("documents")[0])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
