"""Daily metrics and lags as mergeable states, their final values and the revenue rollup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.numbers import exact_sum
from eventmart.functions.times import day_start
from eventmart.functions.values import PURCHASE
from eventmart.schemas import DAILY_KEYS, EVENTS_AGG_DAILY, LAG_STATES

LAG_SHARES = {"p50_lag": 0.5, "p95_lag": 0.95, "p99_lag": 0.99}


def _daily(events: DataFrame) -> DataFrame:
    return events.select(F.to_date("event_time").alias("event_date"), "channel", "city",
                         "device_type", "event_type", "user_id",
                         F.coalesce("premium_amount", F.lit(0.0)).alias("_premium"))


def daily_states(events: DataFrame) -> DataFrame:
    """Partial states per day, channel, city, device and type. A null premium counts as 0."""
    return (_daily(events).groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("events_count"),
        F.hll_sketch_agg("user_id").alias("unique_users"),
        F.sum("_premium").alias("premium_sum"),
        F.struct(F.sum("_premium").alias("total"), F.count("_premium").alias("n")).alias(
            "premium_avg"))
        .select(*EVENTS_AGG_DAILY.columns))


def merge_states(states: DataFrame) -> DataFrame:
    """Several states of a group as one state, for compaction."""
    return (states.groupBy(*DAILY_KEYS).agg(
        F.sum("events_count").alias("events_count"),
        F.hll_union_agg("unique_users").alias("unique_users"),
        F.sum("premium_sum").alias("premium_sum"),
        F.struct(F.sum("premium_avg.total").alias("total"),
                 F.sum("premium_avg.n").alias("n")).alias("premium_avg"))
        .select(*EVENTS_AGG_DAILY.columns))


def finalize_states(states: DataFrame) -> DataFrame:
    """Final values of the states; the number of users is an estimate."""
    return (states.groupBy(*DAILY_KEYS).agg(
        F.sum("events_count").alias("events_count"),
        F.hll_sketch_estimate(F.hll_union_agg("unique_users")).alias("unique_users"),
        F.sum("premium_sum").alias("premium_sum"),
        (F.sum("premium_avg.total") / F.sum("premium_avg.n")).alias("premium_avg")))


def lag_states(events: DataFrame) -> DataFrame:
    """Sketches of the ingest lags per day and type, in which quantiles of any merged set of them are
    found within about 1.5 % of the rank, in a few KB whatever the number of events."""
    return (events.where(F.col("ingest_lag_sec").isNotNull())
            .groupBy(F.to_date("event_time").alias("event_date"), "event_type").agg(
                F.count(F.lit(1)).alias("n"), F.max("ingest_lag_sec").alias("max_lag"),
                F.kll_sketch_agg_bigint("ingest_lag_sec").alias("lags"))
            .select(*LAG_STATES.columns))


def lag_quantiles(states: DataFrame, by: Sequence[str] = ("event_type",),
                  shares: Mapping[str, float] = LAG_SHARES) -> DataFrame:
    """Quantiles of the lags in all states of each group, their number and the largest."""
    merged = states.groupBy(*by).agg(
        F.sum("n").alias("n"), F.max("max_lag").alias("max_lag"),
        F.kll_merge_agg_bigint("lags").alias("lags"))
    return merged.select(*by, "n", "max_lag", *[
        F.kll_sketch_get_quantile_bigint("lags", F.lit(share)).alias(name) for name, share in shares.items()])


def daily_metrics(events: DataFrame) -> DataFrame:
    """The same metrics straight from the events, with exact numbers of users."""
    return (_daily(events).groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("events_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("_premium").alias("premium_sum"),
        (F.sum("_premium") / F.count(F.lit(1))).alias("premium_avg")))


def purchases_by_day_and_channel(daily: DataFrame) -> DataFrame:
    return (daily.filter(F.col("event_type") == PURCHASE)
            .groupBy("event_date", "channel")
            .agg(F.sum("events_count").alias("c"))
            .orderBy("event_date", F.desc("c"), "channel"))


def revenue_by_line_and_day(facts: DataFrame) -> DataFrame:
    """The rollup behind revenue dashboards; store it and read it instead of the facts."""
    return (facts.groupBy("product_line", day_start("event_time").alias("day"))
            .agg(exact_sum("net_amount").alias("revenue"), F.count(F.lit(1)).alias("orders")))


def revenue_by_line_since(facts: DataFrame, since: str | Column) -> DataFrame:
    start = F.lit(since).cast("timestamp") if isinstance(since, str) else since
    return (facts.filter(F.col("event_time") >= start)
            .groupBy("product_line").agg(exact_sum("net_amount").alias("revenue")))
