"""Every registered query against its SQL, on the smallest driver tables."""

import pytest

import __spark_entry__ as driver
from harness import incremental
from harness import oracles as harness_oracles
from harness import queries as harness_queries
from harness.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], duck) == ""


def test_preview_gives_five_rows_of_the_table(spark):
    got = QUERIES["preview_limit"](spark, SF_DIR)
    everything = QUERIES["preview_all_string"](spark, SF_DIR)
    assert got.count() == 5 and got.intersect(everything).count() == 5


def test_all_have_sql():
    assert set(incremental.QUERIES) == set(incremental.ORACLES)
    assert set(harness_queries.QUERIES) == set(harness_oracles.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert driver.entry(spark).count() > 0
