"""Typing of event rows and enrichment with user attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.numbers import blank_to_null, premium_value
from eventmart.functions.times import moment, parse_date, parse_time, seconds_between
from eventmart.functions.values import EPOCH_DATE, UNKNOWN
from eventmart.operators.skew import BROADCAST_BYTES, lookup_join
from eventmart.schemas import EVENTS_ENRICHED, EVENTS_FILE_TEXT, USER_EVENTS, USERS

USER_COLUMNS = ("user_id", "city", "device_type", "signup_date")


def type_events(rows: DataFrame) -> DataFrame:
    """Text rows as typed events; a blank or missing premium becomes null."""
    for name in EVENTS_FILE_TEXT.fieldNames():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    return rows.select(
        "event_time",
        blank_to_null("user_id").try_cast("bigint").alias("user_id"),
        "session_id", "event_type", "channel",
        premium_value("premium_amount").alias("premium_amount"))


def load_events(rows: DataFrame) -> DataFrame:
    """Text rows in the shape of the raw ``user_events`` table, times parsed."""
    return type_events(rows).withColumn("event_time", parse_time("event_time")).select(
        *USER_EVENTS.columns)


def load_users(rows: DataFrame, loaded_at: str | Column | None = None) -> DataFrame:
    """User file rows in the shape of the users table."""
    return rows.select(
        F.col("user_id").cast("bigint"), parse_date("signup_date").alias("signup_date"),
        "city", "device_type", moment(loaded_at).alias("updated_at")).select(*USERS.columns)


def with_users(events: DataFrame, users: DataFrame, spread: tuple[str, ...],
               max_bytes: int = BROADCAST_BYTES, broadcast: bool | None = None) -> DataFrame:
    """Left join to the users; nothing is filled in for users that are not there."""
    return lookup_join(events, users.select(*USER_COLUMNS), ["user_id"], "left", spread,
                       max_bytes, broadcast)


def enrich(events: DataFrame, users: DataFrame, ingested_at: str | Column | None = None,
           max_bytes: int = BROADCAST_BYTES, broadcast: bool | None = None) -> DataFrame:
    """Live enrichment: events with stream position in, enriched rows out.

    Unknown users get ``UNKNOWN`` for city and device and the epoch as their signup date.
    """
    at = moment(ingested_at)
    joined = with_users(events, users, ("kafka_partition", "kafka_offset"), max_bytes,
                        broadcast)
    return joined.select(
        "event_time", "user_id", "session_id", "event_type", "channel", "premium_amount",
        F.coalesce("city", F.lit(UNKNOWN)).alias("city"),
        F.coalesce("device_type", F.lit(UNKNOWN)).alias("device_type"),
        F.coalesce("signup_date", F.lit(EPOCH_DATE).cast("date")).alias("signup_date"),
        "kafka_topic", F.col("kafka_partition").cast("bigint").alias("kafka_partition"),
        "kafka_offset", "kafka_timestamp", at.alias("_ingested_at"),
        seconds_between("kafka_timestamp", at).alias("ingest_lag_sec"),
    ).select(*EVENTS_ENRICHED.columns)
