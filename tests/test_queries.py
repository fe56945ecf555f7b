"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as driver
from oracle import compare, connect
from titlemart.catalog import all_oracles, all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {
        "genres", "movie_title", "movie_id", "year", "movie_country", "movie_popularity",
    }


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
