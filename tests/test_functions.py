import hashlib
import json

import pytest
from pyspark.sql import functions as F

from eventmart.functions import messages, numbers, routing, times
from eventmart.functions.values import PRODUCT_LINES


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, want", [
    ("", None), ("   ", None), ("\t", None), (None, None), ("1500.5", 1500.5), (" 7 ", 7.0),
    ("many", None)])
def test_premium_value(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "p STRING")
    assert df.select(numbers.premium_value("p").alias("x")).first()["x"] == want


@pytest.mark.parametrize("value, want", [
    (123456.5, "123456.5"), (12345678.0, "12345678"), (100.0, "100"), (0.0, "0"),
    (1.10, "1.1"), (558259830.25, "558259830.25")])
def test_number_text_of_doubles(spark, value, want):
    assert one(spark, F.expr(numbers.number_text("v")), v=value) == want


def test_number_text_of_integers_and_decimals(spark):
    df = spark.sql("SELECT 100 i, CAST(1.10 AS DECIMAL(4,2)) a, CAST(10 AS DECIMAL(4,2)) b, "
                   "CAST(0 AS DECIMAL(4,2)) c")
    assert tuple(df.selectExpr(*[numbers.number_text(n) for n in "iabc"]).first()) == (
        "100", "1.1", "10", "0")


@pytest.mark.parametrize("net, want", [
    (150000.0, 200000.0), (250000.0, 200000.0), (249999.0, 200000.0), (350000.0, 400000.0)])
def test_ties_round_to_even(spark, net, want):
    assert one(spark, numbers.half_even("v", -5), v=net) == want


def test_line_is_the_md5_modulo_four(spark):
    keys = [(u, f"s-{u * 7}") for u in range(200)]
    df = spark.createDataFrame(keys, "u BIGINT, s STRING")
    got = {r["u"]: r["line"] for r in df.select("u", routing.stable_line("u", "s").alias("line"))
           .collect()}
    for user, session in keys:
        digest = int(hashlib.md5(f"{user}:{session}".encode()).hexdigest(), 16)
        assert got[user] == PRODUCT_LINES[digest % 4]
    assert one(spark, routing.stable_line("u", "s"), u="42", s="sess-1") == "medical"


def test_price_parts(spark):
    df = spark.createDataFrame([(1000.0, 0.1), (None, 0.1), (333.33, 0.15)],
                               "premium DOUBLE, rate DOUBLE")
    parts = numbers.price_parts("premium", "rate")
    got = [tuple(map(float, r)) for r in df.select(*parts.values()).collect()]
    assert got == [(100.0, 81.0, 981.0), (0.0, 0.0, 0.0), (50.0, 25.5, 308.83)]


def test_event_json_writes_nulls_and_reads_back(spark):
    df = spark.createDataFrame(
        [("2025-10-01 10:00:00", 7, "s", "view", "app", None)],
        "event_time STRING, user_id BIGINT, session_id STRING, event_type STRING, "
        "channel STRING, premium_amount DOUBLE")
    text = df.select(messages.event_json().alias("j")).first()["j"]
    assert json.loads(text) == {
        "event_time": "2025-10-01 10:00:00", "user_id": 7, "session_id": "s",
        "event_type": "view", "channel": "app", "premium_amount": None}


def test_times(spark):
    assert one(spark, times.month_number(F.to_timestamp("t")), t="2025-10-31 23:59:59") == 202510
    assert one(spark, times.parse_time("t"), t="no time") is None
    assert str(one(spark, times.parse_date("t"), t="2025-02-03")) == "2025-02-03"
    assert one(spark, times.parse_date("t"), t="2025-02-31") is None
    assert one(spark, times.seconds_between(F.to_timestamp("a"), F.to_timestamp("b")),
               a="2025-10-01 00:00:00", b="2025-10-01 00:01:30") == 90
    assert one(spark, times.time_text(times.day_start(F.to_timestamp("t"))),
               t="2025-10-31 23:59:59") == "2025-10-31 00:00:00"
