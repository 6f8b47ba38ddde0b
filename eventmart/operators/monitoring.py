"""Monitoring tables: volume, consumer lag, missing offsets and days, drift of fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.schemas import EVENT_FIELDS

RUN = 32768
BASELINE_SECONDS = 7 * 86400


def hourly_volume(events: DataFrame) -> DataFrame:
    """Events per hour from the first to the last hour, hours without events as 0.

    Days are spread over tasks before they unfold into hours, so a stray event far in the future
    makes many rows but no large task.
    """
    counts = events.groupBy(F.date_trunc("hour", "event_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"))
    span = counts.agg(F.min("hour").alias("a"), F.max("hour").alias("b"))
    days = span.select("a", "b", F.explode(F.expr(
        "sequence(to_date(a), to_date(b), INTERVAL 1 DAY)")).alias("day")).repartition("day")
    hours = days.select("a", "b", F.explode(F.expr(
        "sequence(timestamp(day), timestamp(day) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)")).alias(
        "hour")).filter("hour BETWEEN a AND b").select("hour")
    return hours.join(counts, "hour", "left").select(
        "hour", F.coalesce("events", F.lit(0)).alias("events"))


def volume_anomalies(events: DataFrame, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Hours against the mean of the seven days before them.

    Windows run within a week that also holds the hours of the week before: 336 rows at most,
    however long the history is.
    """
    trailing = Window.partitionBy("_week").orderBy("_second").rangeBetween(-BASELINE_SECONDS, -1)
    second = F.unix_timestamp("hour")
    week = F.floor(second / BASELINE_SECONDS)
    hours = hourly_volume(events).withColumn("_second", second).select(
        "*", week.alias("_own"), F.explode(F.array(week, week + 1)).alias("_week"))
    scored = hours.withColumn("baseline", F.avg("events").over(trailing)).filter(
        "_week = _own").select("hour", "events", "baseline")
    ratio = F.col("events") / F.nullif(F.col("baseline"), F.lit(0.0))
    return scored.withColumn(
        "flag", F.when(ratio < low, "LOW").when(ratio > high, "HIGH").otherwise("OK"))


def partition_progress(events: DataFrame) -> DataFrame:
    """Rows read and the last offset seen per partition."""
    return events.groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("num_messages_read"), F.max("kafka_offset").alias("last_offset"))


def partition_lag(latest: DataFrame, progress: DataFrame, threshold: int) -> DataFrame:
    """Messages behind the source per partition.

    ``latest`` has the newest offset of each source partition; a partition never read lags
    by all of its messages, offset 0 included.
    """
    lag = F.col("latest_offset") - F.coalesce("last_offset", F.lit(-1))
    return (latest.join(progress.select("kafka_partition", "last_offset"), "kafka_partition",
                        "left")
            .select("kafka_partition", "latest_offset", "last_offset", lag.alias("lag"),
                    F.when(lag > threshold, "LAGGING").otherwise("OK").alias("status")))


def offset_bitmaps(events: DataFrame) -> DataFrame:
    """The offsets of each partition as bitmaps, one per run of 32,768 offsets.

    ``(kafka_partition, _run, _bits, _first, _last)``; bit i of a run stands for offset
    ``_run * 32768 + i``. Whatever the number of events, a run leaves a map task as 4 KB, and
    offsets that were stored many times cost no more than once.
    """
    at = F.col("kafka_offset") + 1
    return (events.groupBy("kafka_partition", (F.bitmap_bucket_number(at) - 1).alias("_run"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"),
                 F.min("kafka_offset").alias("_first"), F.max("kafka_offset").alias("_last")))


def offset_ranges(events: DataFrame) -> DataFrame:
    """Expected and actual number of distinct offsets per partition, exactly."""
    return offset_bitmaps(events).groupBy("kafka_partition").agg(
        (F.max("_last") - F.min("_first") + 1).alias("expected"),
        F.sum(F.bitmap_count("_bits")).alias("actual"))


def missing_offsets(events: DataFrame) -> DataFrame:
    """Offset ranges to replay: ``(kafka_partition, from_offset, to_offset, missing)``.

    Only runs with holes are taken apart, each a window group of at most 32,768 offsets.
    Gaps between runs come from the first and last offsets of neighbouring runs.
    """
    bitmaps = offset_bitmaps(events)
    holed = bitmaps.filter(F.bitmap_count("_bits") < F.col("_last") - F.col("_first") + 1)
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_i div 8 + 1 as int), 1)), 16, 10) as int)")
    present = (holed.select("kafka_partition", "_run", "_bits",
                            F.explode(F.sequence(F.lit(0), F.lit(RUN - 1))).alias("_i"))
               .filter(F.getbit(byte, F.col("_i") % 8) == 1)
               .select("kafka_partition", "_run",
                       (F.col("_run") * RUN + F.col("_i")).alias("_last")))
    inside = present.select("kafka_partition", "_last", F.lead("_last").over(
        Window.partitionBy("kafka_partition", "_run").orderBy("_last")).alias("_next"))
    between = bitmaps.select("kafka_partition", "_last", F.lead("_first").over(
        Window.partitionBy("kafka_partition").orderBy("_run")).alias("_next"))
    return inside.unionByName(between).filter(F.col("_next") - F.col("_last") > 1).select(
        "kafka_partition", (F.col("_last") + 1).alias("from_offset"),
        (F.col("_next") - 1).alias("to_offset"),
        (F.col("_next") - F.col("_last") - 1).alias("missing"))


def daily_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"))


def daily_gaps(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Days with fewer events than expected; the rows name what to backfill."""
    found = actual.withColumnRenamed("events", "actual")
    return (expected.withColumnRenamed("events", "expected").join(found, "event_date", "left")
            .select("event_date", "expected", F.coalesce("actual", F.lit(0)).alias("actual"))
            .withColumn("missing", F.col("expected") - F.col("actual"))
            .withColumn("backfill", F.col("missing") > 0))


def field_drift(messages: DataFrame, declared: Sequence[str] = EVENT_FIELDS) -> DataFrame:
    """Fields of the messages against the declared ones, with counts of rows.

    ``missing_rows`` counts readable messages that lack a declared field.
    """
    names = F.array(*[F.lit(name) for name in declared])
    keys = messages.select(F.json_object_keys("value").alias("_keys")).filter(
        F.col("_keys").isNotNull())
    fields = keys.select("_keys", F.explode(F.array_union(names, "_keys")).alias("field"))
    present = F.array_contains("_keys", F.col("field"))
    counted = fields.groupBy("field").agg(F.count_if(present).alias("present_rows"),
                                          F.count_if(~present).alias("missing_rows"))
    known = F.array_contains(names, F.col("field"))
    return counted.withColumn(
        "status", F.when(~known, "UNKNOWN_FIELD").when(F.col("missing_rows") > 0, "MISSING_FIELD")
        .otherwise("OK"))
