"""Small tables for the tests of the training-data operators."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT)]

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A function from texts to a table of documents, with clashing extra columns."""

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["a"] * len(texts) if sources is None else sources
        rows = [
            (i, t, "en", s, None if t is None else len(t), "x", 1.0)
            for i, t, s in zip(ids, texts, sources, strict=True)
        ]
        return spark.createDataFrame(rows, DOCUMENTS + ", node string, score double")

    return make


@pytest.fixture(scope="session")
def given(spark):
    """The smallest given table, in Spark and in Python."""

    def read(name, sf="sf0.001"):
        df = spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
        return df, [tuple(r) for r in df.collect()]

    return read


AWKWARD = [
    None, "", " ", "\t\n", "one", "Two words", "a b c d", "a b c d", "A B C D e", "é è 😀 ß x",
    "x" * 5000, "tie tie tie tie tie tie", "+1 (22) 333-4444 and a@b.co", "word " * 3000,
]


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty, very long, equal and short texts."""
    return list(AWKWARD)
