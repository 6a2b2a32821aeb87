"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from helpers import executed_plan, rows_of

import __spark_entry__ as contract
from incident_analytics.twins.oracle import all_oracles
from incident_analytics.twins.queries import all_queries

SF_DIR = os.environ.get("TWIN_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
DUCKDB_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_no_subsets():
    for name, sql in ORACLES.items():
        assert "%" not in sql, name
        assert sql.count("LIMIT") == sql.count("LIMIT 3"), name


def test_entry(spark):
    assert len(contract.entry(spark).collect()) == 21


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = rows_of(df.select(*columns))
    relation = con.sql(ORACLES[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: DUCKDB_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    at = [relation.columns.index(c) for c in columns]
    assert got == sorted([tuple(row[i] for i in at) for row in relation.fetchall()], key=repr)
    assert got
    plan = executed_plan(df)
    assert not re.search("Python|CartesianProduct|NestedLoop", plan)
