"""Data-quality checks: one row ``(check_name, status, metric)`` each, and the gate over them.

All checks that look at single event rows share one scan. It counts rows per distinct lag, and these
counts, far fewer than the events, are written once; the profile and the exact percentile, which looks
at bins of lags and into one or two of these, read them back. The checks on the profile unfold from
one row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.numbers import half_even
from eventmart.functions.times import moment, time_text
from eventmart.functions.values import EPOCH_TIME, LAG_LIMIT_SECONDS, PURCHASE, UNKNOWN
from eventmart.operators.monitoring import offset_ranges
from eventmart.session import run_dir

# Seconds of lag to a bin of the percentile's first step.
LAG_BIN = 4096

CHECK_COLUMNS = ("check_name", "status", "metric")


def _check(name: str, passed: Column, metric: Column, otherwise: str = "FAIL") -> Column:
    return F.struct(F.lit(name).alias("check_name"),
                    F.when(passed, F.lit("PASS")).otherwise(F.lit(otherwise)).alias("status"),
                    metric.alias("metric"))


def _rows(frame: DataFrame, *checks: Column) -> DataFrame:
    return frame.select(F.inline(F.array(*checks)))


def _text(label: str, value: Column | str, empty: str = "0") -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit(empty)))


def lag_histogram(events: DataFrame) -> DataFrame:
    """Counts and maxima of the events per second of ingest lag."""
    is_purchase = F.col("event_type") == PURCHASE
    has_premium = F.col("premium_amount").isNotNull()
    return events.groupBy("ingest_lag_sec").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("city") == UNKNOWN).alias("unmatched"),
        F.count_if(is_purchase & ~has_premium).alias("null_premium"),
        F.count_if(~is_purchase & has_premium).alias("odd_premium"),
        F.count_if(is_purchase).alias("purchase_events"),
        F.max("_ingested_at").alias("max_ingested_at"),
        F.max("event_time").alias("max_event_time"))


def event_profile(events: DataFrame) -> DataFrame:
    """One row with every number the row-level checks need. The events are read here, once."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    lags = lag_histogram(events)
    folder = run_dir(events.sparkSession, "lags")
    lags.write.parquet(folder)
    lags = events.sparkSession.read.schema(lags.schema).parquet(folder)
    return lags.agg(
        total("n"), total("unmatched"), total("null_premium"), total("odd_premium"),
        total("purchase_events"), F.max("max_ingested_at").alias("max_ingested_at"),
        F.max("max_event_time").alias("max_event_time"),
        F.max("ingest_lag_sec").alias("max_lag")).withColumn("_one", F.lit(1)).join(
        weighted_percentile(lags, "ingest_lag_sec", 0.95).select(
            F.lit(1).alias("_one"), F.col("value").alias("p95_lag")), "_one", "left").drop("_one")


def weighted_percentile(counts: DataFrame, column: str, share: float,
                        width: int = LAG_BIN) -> DataFrame:
    """One row with the exact percentile ``value`` of a whole-number column with row counts ``n``.

    Values are first summed in bins of ``width``, and only the bins that hold the two ranks in
    question are taken apart, so no task sees all values. Between two values it interpolates, as
    Spark's percentile does. Nulls do not count; without values the value is null.
    """
    known = counts.where(F.col(column).isNotNull()).select(F.col(column).alias("v"), "n")
    bins = known.groupBy(F.floor(F.col("v") / width).alias("bin")).agg(F.sum("n").alias("n"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bins.select("bin", "n", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("before"),
                         F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    place = (F.col("total") - 1) * F.lit(share)
    wanted = ranked.select("*", place.alias("place"), F.floor(place).alias("low"),
                           F.ceil(place).alias("high")).where(
        "before <= high AND before + n > low")
    inside = known.join(wanted.drop("n"), F.floor(known.v / width) == wanted.bin).select(
        "v", "n", "bin", "before", "place", "low", "high")
    first = F.col("before") + F.coalesce(F.sum("n").over(Window.partitionBy("bin").orderBy(
        "v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = inside.withColumn("first", first)
    low = F.max(F.when((F.col("first") <= F.col("low")) & (F.col("first") + F.col("n") > F.col("low")), F.col("v")))
    high = F.max(F.when((F.col("first") <= F.col("high")) & (F.col("first") + F.col("n") > F.col("high")), F.col("v")))
    part = F.max(F.col("place") - F.col("low"))
    return at.agg(low.alias("a"), high.alias("b"), part.alias("part")).select(
        (F.col("a") + F.col("part") * (F.col("b") - F.col("a"))).cast("double").alias("value"))


def _parity(expected: int) -> Column:
    return _check("row_count_parity", F.abs(F.col("n") - F.lit(expected)) == 0,
                  F.concat(_text("clickhouse=", "n"), F.lit(f" expected={expected}")))


def _integrity() -> Column:
    return _check("referential_integrity_users", F.col("unmatched") == 0,
                  _text("unmatched_users=", "unmatched"))


def _null_premium() -> Column:
    return _check("null_premium_on_purchase", F.col("null_premium") == 0,
                  _text("null_purchase_premiums=", "null_premium"))


def _odd_premium() -> Column:
    return _check("premium_on_non_purchase", F.col("odd_premium") == 0,
                  _text("non_purchase_with_premium=", "odd_premium"), "WARN")


def _freshness(as_of: str | Column | None) -> Column:
    return _check(
        "ingestion_freshness",
        F.col("max_ingested_at") >= moment(as_of) - F.expr("INTERVAL 1 DAY"),
        F.concat(_text("max_event_time=", time_text("max_event_time"), EPOCH_TIME),
                 _text(" max_ingested_at=", time_text("max_ingested_at"), EPOCH_TIME)))


def _coverage() -> Column:
    return _check("denorm_purchase_coverage", F.col("fact_rows") <= F.col("purchase_events"),
                  F.concat(_text("fact_rows=", "fact_rows"), _text(" purchase_events=", "purchase_events")))


def _lag() -> Column:
    return _check("ingestion_lag", F.col("p95_lag") < LAG_LIMIT_SECONDS,
                  F.concat(_text("p95_lag_sec=", half_even("p95_lag").cast("bigint"), "nan"),
                           _text(" max_lag_sec=", "max_lag")), "WARN")


def with_fact_rows(profile: DataFrame, facts: DataFrame) -> DataFrame:
    """The profile with the number of facts. Two one-row frames are added, not crossed."""
    rows = profile.withColumn("fact_rows", F.lit(0).cast("bigint")).unionByName(
        facts.agg(F.count(F.lit(1)).alias("fact_rows")), allowMissingColumns=True)
    return rows.agg(*[F.max(name).alias(name) for name in rows.columns])


def row_count_parity(profile: DataFrame, expected: int) -> DataFrame:
    return _rows(profile, _parity(expected))


def referential_integrity(profile: DataFrame) -> DataFrame:
    return _rows(profile, _integrity())


def null_premium(profile: DataFrame) -> DataFrame:
    return _rows(profile, _null_premium())


def premium_on_non_purchase(profile: DataFrame) -> DataFrame:
    return _rows(profile, _odd_premium())


def duplicate_count(events: DataFrame) -> DataFrame:
    """Rows beyond the first of each natural key, as one number."""
    groups = events.groupBy("event_time", "user_id", "session_id", "event_type").agg(
        F.count(F.lit(1)).alias("c"))
    return groups.agg((F.coalesce(F.sum("c"), F.lit(0)) - F.count(F.lit(1))).alias("extra"))


def duplicate_events(events: DataFrame) -> DataFrame:
    return _rows(duplicate_count(events), _check(
        "duplicate_events", F.col("extra") == 0, _text("extra_duplicate_rows=", "extra")))


def freshness(profile: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    return _rows(profile, _freshness(as_of))


def denorm_coverage(profile: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts may not outnumber purchases."""
    return _rows(with_fact_rows(profile, facts), _coverage())


def profile_checks(profile: DataFrame, facts: DataFrame, expected: int,
                   as_of: str | Column | None = None) -> DataFrame:
    """The seven checks that need no more than the profile and the number of facts, from one row."""
    return _rows(with_fact_rows(profile, facts), _parity(expected), _integrity(), _null_premium(),
                 _odd_premium(), _freshness(as_of), _coverage(), _lag())


def consumer_errors(consumers: DataFrame, dead_letters: DataFrame | None = None) -> DataFrame:
    """Consumer health from rows with ``num_messages_read``, one per assignment.

    The plain form only reports and cannot fail; with ``dead_letters`` it fails if there are any.
    """
    zero = F.lit(0).cast("bigint")
    counts = consumers.agg(
        F.coalesce(F.max("num_messages_read"), zero).cast("bigint").alias("most_read"),
        F.count(F.lit(1)).alias("assignments"), zero.alias("dead"))
    metric = _text("assignments=", "assignments")
    if dead_letters is not None:
        counts = counts.unionByName(dead_letters.agg(
            zero.alias("most_read"), zero.alias("assignments"), F.count(F.lit(1)).alias("dead")))
        counts = counts.agg(F.max("most_read").alias("most_read"),
                            F.sum("assignments").alias("assignments"),
                            F.sum("dead").alias("dead"))
        metric = F.concat(metric, _text(" dead_letters=", "dead"))
    return _rows(counts, _check("kafka_consumer_errors",
                                (F.col("most_read") >= 0) & (F.col("dead") == 0), metric))


def offset_continuity(events: DataFrame) -> DataFrame:
    totals = offset_ranges(events).agg(
        F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"),
        F.coalesce(F.sum("actual"), F.lit(0)).alias("actual"))
    return _rows(totals, _check(
        "offset_continuity", F.col("expected") == F.col("actual"),
        _text("missing_in_offset_ranges=", F.col("expected") - F.col("actual"))))


def lag_percentiles(profile: DataFrame) -> DataFrame:
    return profile.select("p95_lag", "max_lag")


def ingestion_lag(profile: DataFrame) -> DataFrame:
    return _rows(profile, _lag())


class Checks(dict):
    """The ten checks by name, built only when called, and what they look at.

    The events are profiled when the first check that needs it is built.
    """

    def __init__(self, events: DataFrame, facts: DataFrame, consumers: DataFrame, expected: int,
                 as_of: str | Column | None = None, dead_letters: DataFrame | None = None) -> None:
        self.events, self.facts, self.consumers, self.expected = events, facts, consumers, expected
        self.as_of, self.dead_letters = as_of, dead_letters
        super().__init__({
            "row_count_parity": lambda: row_count_parity(self.profile, expected),
            "referential_integrity_users": lambda: referential_integrity(self.profile),
            "null_premium_on_purchase": lambda: null_premium(self.profile),
            "premium_on_non_purchase": lambda: premium_on_non_purchase(self.profile),
            "duplicate_events": lambda: duplicate_events(events),
            "ingestion_freshness": lambda: freshness(self.profile, as_of),
            "denorm_purchase_coverage": lambda: denorm_coverage(self.profile, facts),
            "kafka_consumer_errors": lambda: consumer_errors(consumers, dead_letters),
            "offset_continuity": lambda: offset_continuity(events),
            "ingestion_lag": lambda: ingestion_lag(self.profile),
        })

    @cached_property
    def profile(self) -> DataFrame:
        return event_profile(self.events)


def checks(events: DataFrame, facts: DataFrame, consumers: DataFrame, expected: int,
           as_of: str | Column | None = None, dead_letters: DataFrame | None = None) -> Checks:
    return Checks(events, facts, consumers, expected, as_of, dead_letters)


def report(built: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """The checks as one frame; of all ten, seven come from one row."""
    if isinstance(built, Checks):
        return reduce(DataFrame.unionByName, [
            profile_checks(built.profile, built.facts, built.expected, built.as_of),
            duplicate_events(built.events), consumer_errors(built.consumers, built.dead_letters),
            offset_continuity(built.events)])
    return reduce(DataFrame.unionByName, [make() for make in built.values()])


def gate(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count_if(F.col("status") == "FAIL").alias("failures"),
                       F.count_if(F.col("status") == "WARN").alias("warnings"))


@dataclass
class GateResult:
    rows: list[tuple[str, str, str]] = field(default_factory=list)
    failures: int = 0
    warnings: int = 0

    def add(self, name: str, status: str, metric: str) -> None:
        self.rows.append((name, status, metric))
        self.failures += status in ("FAIL", "ERROR")
        self.warnings += status == "WARN"


def run_gate(built: Mapping[str, Callable[[], DataFrame]]) -> GateResult:
    """Run the checks; one that raises counts as a failure, one without a row is skipped.

    They run together first and one by one only if that raises, and are told in their order.
    """
    try:
        found = report(built).collect()
    except Exception:
        found = None
    result = GateResult()
    if found is not None:
        places = {name: i for i, name in enumerate(built)}
        for row in sorted(found, key=lambda row: places.get(row["check_name"], 0)):
            result.add(*row)
        return result
    for name, make in built.items():
        try:
            found = make().collect()
        except Exception as error:
            result.add(name, "ERROR", str(error).splitlines()[0])
            continue
        for row in found:
            result.add(*row)
    return result
