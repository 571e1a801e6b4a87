"""Every registered query against its SQL, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, digest
from tidelake.contract import load_queries

QUERIES, ORACLES = load_queries()
# Queries that write files or run streams while they are built.
WRITERS = {n for n in QUERIES if n.startswith(("write_", "stream_", "read_archive", "read_csv", "read_zip", "read_prov", "read_parquet_source_drift", "bulk_round", "collect_and", "mirror_round", "compact", "ledger"))}


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows) == digest(columns, expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_no_plan_pairs_everything_or_evaluates_rows_in_python(spark, sf):
    for name in sorted(set(QUERIES) - WRITERS):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert operator not in plan, f"{name} contains {operator}"


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "source_slug", "sport_slug", "event_date", "rows", "min_ts", "max_ts",
    ]
