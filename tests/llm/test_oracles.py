"""Queries with SQL against DuckDB, on whole tables."""

import os

import duckdb
import pytest

from incident_analytics.llm.queries import llm_oracles, llm_queries

SF_DIR = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(spark, name):
    got = llm_queries()[name](spark, SF_DIR)
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    relation = con.sql(llm_oracles()[name])
    assert got.columns == relation.columns
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert [kinds[k] for _, k in got.dtypes] == [str(t) for t in relation.types]
    assert sorted(map(tuple, got.collect())) == sorted(relation.fetchall())
