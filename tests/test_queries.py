"""Every registered query against its SQL on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from rowsmith.queries import ORACLES, QUERIES
from tools.check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    problem, _ = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert problem is None


def test_forest_learns_the_language(spark):
    rows = {r["split"]: r for r in QUERIES["train_random_forest"](spark, SF).collect()}
    assert rows["test"]["accuracy"] > 0.9


def test_entry(spark):
    assert entry_module.entry(spark).count() > 3
