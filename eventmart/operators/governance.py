"""Masked and restricted views, what each audience sees, retention and erasure."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.numbers import half_even
from eventmart.functions.times import moment
from eventmart.functions.values import NET_BUCKET_DIGITS, RETENTION_MONTHS

# Which tables an audience may read.
AUDIENCES = {
    "analyst": ("events_agg_daily_v", "fact_purchases_masked"),
    "data_scientist": ("events_agg_daily_v", "fact_purchases_masked", "events_enriched"),
    "finance": ("fact_purchases", "financial_order"),
}


def masked_purchases(facts: DataFrame) -> DataFrame:
    """Facts without exact money: the net amount as its nearest 100,000, nine other columns."""
    return facts.select(
        "event_time", "user_id", "city", "device_type", "channel", "product_line", "attributes",
        half_even("net_amount", NET_BUCKET_DIGITS).alias("net_amount_bucket"),
        "payment_method", "payment_status")


def restrict(df: DataFrame, **allowed: str) -> DataFrame:
    """Rows an audience may see, such as ``restrict(facts, city="Tehran")``."""
    for name, value in allowed.items():
        df = df.filter(F.col(name) == value)
    return df


def tables_for(audience: str, tables: Mapping[str, DataFrame],
               **allowed: str) -> dict[str, DataFrame]:
    """The tables of one audience; row restrictions apply where a table has the column."""
    visible = {}
    for name in AUDIENCES[audience]:
        if name == "fact_purchases_masked":
            df = masked_purchases(restrict(tables["fact_purchases"], **allowed))
        else:
            df = tables[name]
            df = restrict(df, **{k: v for k, v in allowed.items() if k in df.columns})
        visible[name] = df
    return visible


def publish_views(audience: str, tables: Mapping[str, DataFrame], **allowed: str) -> list[str]:
    """Register an audience's tables as temporary views ``<audience>_<table>``."""
    names = []
    for name, df in tables_for(audience, tables, **allowed).items():
        df.createOrReplaceTempView(f"{audience}_{name}")
        names.append(f"{audience}_{name}")
    return names


def retained(df: DataFrame, as_of: str | Column | None = None,
             months: int = RETENTION_MONTHS, time: str = "event_time") -> DataFrame:
    """Rows younger than the retention period, tested as time plus period against ``as_of``.

    The second filter follows from the first. It is a plain bound on the column, which the
    scan can use to skip row groups; two days of slack cover months of unequal length.
    """
    at = moment(as_of)
    bound = F.date_sub(F.add_months(F.to_date(at), -months), 2).cast("timestamp")
    return (df.filter(F.col(time) + F.expr(f"INTERVAL {months} MONTH") > at)
            .filter(F.col(time) > bound))


def erased(df: DataFrame, subjects: DataFrame) -> DataFrame:
    """Rows of everybody but the subjects. AQE splits a hot user's rows if this shuffles."""
    return df.join(subjects.select("user_id"), "user_id", "left_anti")
