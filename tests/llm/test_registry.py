"""The registered queries at sf0.01 against their DuckDB counterparts."""

import pytest

from airshed.llm import queries

from ..oracle import compare

SF01 = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    res = compare(spark, SF01, name, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert res["ok"], res
