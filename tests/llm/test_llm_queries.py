"""Registered queries against their DuckDB twins."""

import pytest
from compare import compare, connect

from hirelake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    rows, extra, missing = compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert rows > 0 and not extra and not missing
