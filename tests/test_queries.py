"""Every registered query against its SQL twin."""

import pytest
from compare import compare, connect

from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    rows, extra, missing = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert not extra and not missing
    assert rows > 0


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["word", "frequency"] and df.count() == 300
