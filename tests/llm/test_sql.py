"""Queries that SQL can express, against that SQL."""

import duckdb
import pytest

from rowsmith.llm.queries import LLM_ORACLES, LLM_QUERIES
from tools.check_oracle import TABLES, compare


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    problem, _ = compare(spark, con, sf_dir, LLM_QUERIES[name], LLM_ORACLES[name])
    assert problem is None


def test_every_operator_has_a_query():
    numbers = {int(name[2:].split("_")[0]) for name in LLM_QUERIES if name.startswith("op")}
    assert numbers == set(range(1, 14))
