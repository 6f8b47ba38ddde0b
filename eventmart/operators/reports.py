"""Report tables: six sections of the verification report and smaller extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.numbers import half_even
from eventmart.functions.values import PURCHASE, UNKNOWN


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def enriched_profile(events: DataFrame, exact: bool = False) -> DataFrame:
    users = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id", 0.01)
    return events.agg(F.count(F.lit(1)).alias("rows"), users.alias("users"),
                      F.min("event_time").alias("min_event_time"),
                      F.max("event_time").alias("max_event_time"))


def enrichment_coverage(events: DataFrame) -> DataFrame:
    return events.agg(F.count_if(F.col("city") == UNKNOWN).alias("unmatched"),
                      F.count(F.lit(1)).alias("total"))


def by_event_type(daily: DataFrame) -> DataFrame:
    """Events per type from the daily rows.

    ``approx_users`` adds up the users of each daily group, so a user counts once per group,
    and ``avg_premium`` averages the groups' averages without weights.
    """
    return (daily.groupBy("event_type").agg(
        F.sum("events_count").alias("events"),
        F.sum("unique_users").alias("approx_users"),
        half_even(F.avg("premium_avg")).alias("avg_premium"))
        .orderBy(F.desc("events"), "event_type"))


def by_event_type_merged(states: DataFrame) -> DataFrame:
    """The same per type with merged sketches and a weighted average."""
    return (states.groupBy("event_type").agg(
        F.sum("events_count").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("unique_users")).alias("approx_users"),
        half_even(F.sum("premium_avg.total") / F.sum("premium_avg.n")).alias("avg_premium"))
        .orderBy(F.desc("events"), "event_type"))


def purchase_channels(daily: DataFrame) -> DataFrame:
    return (daily.filter(F.col("event_type") == PURCHASE).groupBy("channel").agg(
        F.sum("events_count").alias("purchases"),
        half_even(F.sum("premium_sum")).alias("premium_sum"))
        .orderBy(F.desc("purchases"), "channel"))


def product_lines(facts: DataFrame) -> DataFrame:
    return (facts.groupBy("product_line").agg(
        F.count(F.lit(1)).alias("orders"),
        half_even(F.avg("net_amount")).alias("avg_net"),
        half_even(F.avg("installments"), 1).alias("avg_installments"))
        .orderBy(F.desc("orders"), "product_line"))


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in an order; all rows, unordered, for n = 0."""
    return df.orderBy(*order).limit(n) if n else df


def verification_report(users: DataFrame, events: DataFrame, daily: DataFrame,
                        facts: DataFrame) -> Mapping[str, DataFrame]:
    return {
        "users": row_count(users, "users"),
        "events_enriched": enriched_profile(events),
        "enrichment_coverage": enrichment_coverage(events),
        "aggregates_by_event_type": by_event_type(daily),
        "purchase_channels": purchase_channels(daily),
        "fact_product_lines": product_lines(facts),
    }
