"""Queries with a check in SQL agree with it, over whole tables."""

import pytest
from oracle import both, connect

from listora.llm.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(name, spark, sf_dir, duck):
    (columns, rows), (wanted_columns, wanted) = both(spark, sf_dir, duck, QUERIES[name], ORACLES[name])
    assert columns == wanted_columns
    assert rows == wanted


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
