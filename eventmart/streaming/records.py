"""Stream records to events or dead letters, and to changes of users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.messages import CORRUPT, event_fields
from eventmart.functions.numbers import blank_to_null, premium_value
from eventmart.functions.times import parse_date, parse_time
from eventmart.schemas import DEAD_LETTERS, EVENT_FIELDS

EVENT_COLUMNS = ("event_time", "user_id", "session_id", "event_type", "channel",
                 "premium_amount", "kafka_topic", "kafka_partition", "kafka_offset",
                 "kafka_timestamp")


def parse_records(records: DataFrame) -> DataFrame:
    """Records with typed event columns, ``_good``, and ``error`` for the others.

    Unknown fields are skipped and quoted numbers accepted. A record is bad if it has no
    value, is not a JSON object, lacks user, type or time, or holds a value of the wrong type.

    The message is unfolded with ``inline``: filters on its fields stay above that step, where
    on a plain struct column each of them would parse the message again.
    """
    names = dict(records.dtypes)
    raw = records.select("*", F.inline(F.array(event_fields("value")))).withColumnsRenamed(
        {name: f"_{name}" for name in EVENT_FIELDS})
    typed = raw.select(
        *names, CORRUPT, *[f"_{name}" for name in EVENT_FIELDS],
        parse_time("_event_time").alias("event_time"),
        blank_to_null("_user_id").try_cast("bigint").alias("user_id"),
        F.coalesce("_session_id", F.lit("")).alias("session_id"),
        F.col("_event_type").alias("event_type"),
        F.coalesce("_channel", F.lit("")).alias("channel"),
        premium_value("_premium_amount").alias("premium_amount"))
    readable = F.col("value").isNotNull() & F.col(CORRUPT).isNull()
    bad_premium = F.col("premium_amount").isNull() & blank_to_null("_premium_amount").isNotNull()

    def missing(name: str):
        return F.when(readable & F.col(name).isNull(), F.concat(
            F.lit(f"{name}: "), F.coalesce(f"_{name}", F.lit("missing"))))

    error = F.concat_ws(
        "; ", F.when(F.col("value").isNull(), F.lit("no value")),
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed message")),
        missing("event_time"), missing("user_id"), missing("event_type"),
        F.when(readable & bad_premium, F.concat(F.lit("premium_amount: "), "_premium_amount")))
    # Never null, so a record is either good or a dead letter.
    good = (F.col("user_id").isNotNull() & F.col("event_time").isNotNull()
            & F.col("event_type").isNotNull() & ~bad_premium & F.col(CORRUPT).isNull())
    return typed.select(*names, *EVENT_FIELDS, good.alias("_good"), error.alias("error"))


def first_deliveries(records: DataFrame, delay: str) -> DataFrame:
    """A stream's records without redelivered ones: of those that hold the same event, the first.

    An event is known for ``delay`` after its first message's time, as long as the watermark takes to
    get there; the state holds no more than that. A copy that comes later passes, and reads that drop
    copies have to find it. A record older than the watermark is dropped. Records that are no event are
    told apart by their position.
    """
    parsed = parse_records(records)
    event = F.struct("event_time", "user_id", "session_id", "event_type")
    position = F.struct("topic", "partition", "offset")
    key = F.when(F.col("_good"), F.to_json(event)).otherwise(F.to_json(position))
    return (parsed.select(*records.columns, key.alias("_event")).withWatermark("timestamp", delay)
            .dropDuplicatesWithinWatermark(["_event"]).drop("_event"))


def good_events(parsed: DataFrame) -> DataFrame:
    """Events of the good records with their position in the stream."""
    return parsed.filter("_good").withColumnsRenamed({
        "topic": "kafka_topic", "partition": "kafka_partition", "offset": "kafka_offset",
        "timestamp": "kafka_timestamp"}).select(*EVENT_COLUMNS)


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Bad records with their text, position and what is wrong with them."""
    return parsed.filter("not _good").select(*DEAD_LETTERS.columns)


CHANGE = ("user_id STRING, signup_date STRING, city STRING, device_type STRING, "
          "updated_at STRING, __deleted STRING, _corrupt STRING")


def typed_changes(records: DataFrame) -> DataFrame:
    """Records of the users change stream, without tombstones (no value), with typed columns and
    ``error``, null for those that can be applied."""
    raw = records.where("value IS NOT NULL").select("*", F.inline(F.array(F.from_json(
        "value", CHANGE, {"columnNameOfCorruptRecord": "_corrupt"})))).withColumnsRenamed(
        {"user_id": "_user_id", "signup_date": "_signup_date", "updated_at": "_updated_at"})
    days = F.col("_signup_date").try_cast("int")
    typed = raw.select(
        *records.columns, "_corrupt", "_user_id", "_updated_at", "_signup_date",
        F.col("_user_id").try_cast("bigint").alias("user_id"),
        F.when(days.isNotNull(), F.date_add(F.lit("1970-01-01").cast("date"), days))
        .otherwise(parse_date("_signup_date")).alias("signup_date"),
        "city", "device_type", parse_time("_updated_at").alias("updated_at"),
        F.coalesce(F.col("__deleted") == "true", F.lit(False)).alias("_deleted"))

    def unread(name: str):
        return F.when(F.col(name).isNull(), F.concat(
            F.lit(f"{name}: "), F.coalesce(f"_{name}", F.lit("missing"))))

    odd_date = F.when(F.col("signup_date").isNull() & F.col("_signup_date").isNotNull(),
                      F.concat(F.lit("signup_date: "), "_signup_date"))
    error = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed message")).otherwise(
        F.concat_ws("; ", unread("user_id"), unread("updated_at"), odd_date))
    return typed.withColumn("error", F.nullif(error, F.lit("")))


def parse_changes(records: DataFrame) -> DataFrame:
    """Records of the users change stream as rows for ``apply_changes``.

    Values are after-images with a ``__deleted`` flag; records without value are tombstones
    and skipped. Dates come as days since the epoch or as text.
    """
    return typed_changes(records).where("error IS NULL").select(
        "user_id", "signup_date", "city", "device_type", "updated_at",
        F.col("offset").alias("_position"), "_deleted")


def change_dead_letters(records: DataFrame) -> DataFrame:
    """Changes without a readable user, time or date, with their text and what is wrong."""
    return typed_changes(records).where("error IS NOT NULL").select(*DEAD_LETTERS.columns)
