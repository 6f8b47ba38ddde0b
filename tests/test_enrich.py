from datetime import date

import helpers as h

from eventmart.operators import enrich as e
from eventmart.schemas import EVENTS_ENRICHED, USER_EVENTS, USERS

STREAMED = ["event_time", "user_id", "session_id", "event_type", "channel", "premium_amount",
            "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]


def test_rows_are_typed(spark):
    df = spark.createDataFrame(
        [("2025-10-01 10:00:00", "7", "s1", "purchase", "web", "1500.5"),
         ("2025-10-01 10:00:00", " 8 ", "s1", "view", "web", "  ")],
        "event_time STRING, user_id STRING, session_id STRING, event_type STRING, "
        "channel STRING, premium_amount STRING")
    typed = e.type_events(df)
    assert dict(typed.dtypes)["user_id"] == "bigint"
    assert [(r.user_id, r.premium_amount) for r in typed.collect()] == [(7, 1500.5), (8, None)]
    loaded = e.load_events(df)
    assert loaded.columns == USER_EVENTS.columns
    assert loaded.first().event_time == h.T0


def test_a_missing_premium_column_gives_nulls(spark):
    df = spark.createDataFrame([("t", "1", "s", "view", "app")],
                               "event_time STRING, user_id STRING, session_id STRING, "
                               "event_type STRING, channel STRING")
    assert e.type_events(df).first().premium_amount is None


def test_unknown_users_get_defaults(spark):
    rows = h.events(spark, h.event(1), h.event(9, offset=1)).select(*STREAMED)
    out = e.enrich(rows, h.users(spark, (1, "Rome", "ios")), "2025-10-01 10:00:05")
    assert out.columns == EVENTS_ENRICHED.columns
    got = {r.user_id: r for r in out.collect()}
    assert (got[1].city, got[1].device_type, got[1].signup_date) == (
        "Rome", "ios", date(2024, 1, 1))
    assert (got[9].city, got[9].device_type, got[9].signup_date) == (
        "UNKNOWN", "UNKNOWN", date(1970, 1, 1))
    assert got[1].ingest_lag_sec == 5


def test_salted_lookup_gives_the_same_rows(spark, rows):
    data = h.events(spark, *[h.event(i % 3, offset=i) for i in range(30)]).select(*STREAMED)
    people = h.users(spark, (0, "Rome", "ios"), (1, "Bari", "web"))
    small = e.enrich(data, people, "2025-10-01 10:00:05")
    big = e.enrich(data, people, "2025-10-01 10:00:05", max_bytes=0)
    assert rows(small) == rows(big)
    assert small.count() == 30


def test_users_load_with_dates(spark):
    df = spark.createDataFrame([(1, "2024-01-31", "Rome", "ios"), (2, "soon", "Rome", "ios")],
                               "user_id BIGINT, signup_date STRING, city STRING, device_type STRING")
    out = e.load_users(df, "2024-02-01 00:00:00")
    assert out.columns == USERS.columns
    assert [r.signup_date for r in out.orderBy("user_id").collect()] == [date(2024, 1, 31), None]
