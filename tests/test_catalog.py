"""The registered queries: names, and results against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from eventmart.plans.catalog import QUERIES
from eventmart.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "events")
COMPARED = (
    "typed_events", "enriched_events", "agg_daily", "agg_daily_sketch", "fact_purchases",
    "report_by_event_type", "backfill_window", "dq_report", "offset_gaps", "hourly_anomaly",
    "dead_letters", "field_drift", "users_after_changes", "purchases_masked")

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float) and value == int(value):
        return str(int(value))
    return str(value)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@needs_data
@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR)
    wanted = duck.sql(contract.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    order = [wanted.columns.index(c) for c in found.columns]
    assert sorted(tuple(map(plain, r)) for r in found.collect()) == sorted(
        tuple(plain(r[i]) for i in order) for r in wanted.fetchall())


@needs_data
def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
