"""Every query agrees with its check in SQL."""

import pytest
from oracle import both, connect

from listora.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(name, spark, sf_dir, duck):
    (columns, rows), (wanted_columns, wanted) = both(
        spark, sf_dir, duck, QUERIES[name], ORACLES[name]
    )
    assert columns == wanted_columns
    assert rows == wanted


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
