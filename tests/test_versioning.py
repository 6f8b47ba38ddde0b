from datetime import datetime

import pytest

from eventmart.operators import versioning as v

OLD, NEW, NEWER = datetime(2025, 1, 1), datetime(2025, 2, 1), datetime(2025, 3, 1)


def test_latest_version_wins(spark, rows):
    df = spark.createDataFrame([(1, OLD, "a"), (1, NEW, "b"), (2, OLD, "c")],
                               "id BIGINT, at TIMESTAMP, x STRING")
    assert rows(v.latest_version(df, ["id"], "at"), "id", "x") == [(1, "b"), (2, "c")]


def test_equal_versions_keep_the_same_row_in_any_order(spark, rows):
    data = [(1, NEW, "a"), (1, NEW, "b"), (1, NEW, None)]
    schema = "id BIGINT, at TIMESTAMP, x STRING"
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, schema).repartition(3)
        assert rows(v.latest_version(df, ["id"], "at"), "x") == [("b",)]


def test_duplicates_keep_one_row_and_are_deterministic(spark, rows):
    data = [(1, "s", "web"), (1, "s", "app"), (2, "s", "web")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "u BIGINT, s STRING, c STRING")
        assert rows(v.drop_duplicates(df, ["u", "s"])) == [(1, "s", "app"), (2, "s", "web")]


def test_group_limit_comes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS n")
    plan = v.drop_duplicates(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


SCHEMA = "id BIGINT, at TIMESTAMP, city STRING"


@pytest.mark.parametrize("change, want", [
    ((1, NEW, "Milan", 5, False), [(1, "Milan"), (2, "Rome")]),
    ((1, OLD, "Rome", 5, True), [(2, "Rome")]),
    ((3, NEW, "Turin", 5, False), [(1, "Rome"), (2, "Rome"), (3, "Turin")]),
    ((9, NEW, "Bari", 5, True), [(1, "Rome"), (2, "Rome")])])
def test_changes_update_delete_and_insert(spark, rows, change, want):
    base = spark.createDataFrame([(1, OLD, "Rome"), (2, OLD, "Rome")], SCHEMA)
    log = spark.createDataFrame([change], SCHEMA + ", _position BIGINT, _deleted BOOLEAN")
    assert rows(v.apply_changes(base, log, ["id"], "at"), "id", "city") == want


def test_a_later_insert_survives_a_delete(spark, rows):
    base = spark.createDataFrame([(1, OLD, "Rome")], SCHEMA)
    log = spark.createDataFrame(
        [(1, NEW, "Milan", 5, False), (1, NEW, "Milan", 6, True), (1, NEWER, "Turin", 7, False)],
        SCHEMA + ", _position BIGINT, _deleted BOOLEAN")
    assert rows(v.apply_changes(base, log, ["id"], "at"), "city") == [("Turin",)]
    before = v.apply_changes(base, log.filter("_position < 7"), ["id"], "at")
    assert rows(before) == []


def test_maps_break_ties(spark):
    rows = [(1, {"b": "1", "a": "2"}), (1, {"a": "1", "b": "9"})]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k INT, m MAP<STRING, STRING>")
        assert v.drop_duplicates(df, ["k"]).first().m == {"a": "1", "b": "9"}
