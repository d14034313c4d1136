"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    if name in ORACLES:
        assert difference(spark, con, QUERIES[name], ORACLES[name], sf) is None
    else:
        assert QUERIES[name](spark, sf).count() > 0


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert set(entry(spark).columns) == {"lang", "n_blocks", "n_tokens", "pad_share"}
