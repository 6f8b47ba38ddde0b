"""The wide purchase fact: denormalization of new purchases and the gap fill."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.values import EPOCH_TIME, PURCHASE
from eventmart.operators.filters import key_filter, point_filter
from eventmart.operators.orders import latest_financials
from eventmart.operators.skew import BROADCAST_BYTES, salted_join
from eventmart.operators.versioning import drop_duplicates, one_row_per_order
from eventmart.schemas import FACT_PURCHASES
from eventmart.session import run_dir
from eventmart.sources.buckets import SLOT, OrderBuckets

SESSION = ["user_id", "session_id"]
_ORDER_NAMES = {"premium": "order_premium", "created_at": "order_created_at"}
__all__ = [
    "BROADCAST_BYTES", "SESSION", "denormalize", "denormalize_in_buckets", "facts_of", "key_filter", "orders_without_fact",
    "point_filter", "purchase_side", "purchases", "purchases_without_fact", "reconcile"]
_EVENT_COLUMNS = ("event_time", "user_id", "session_id", "channel", "event_premium", "city",
                  "device_type", "signup_date")


def purchases(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == PURCHASE)


def purchase_side(events: DataFrame) -> DataFrame:
    """What facts take from their purchase."""
    return purchases(events).withColumnRenamed("premium_amount", "event_premium").select(
        *_EVENT_COLUMNS)


def _with_financials(matched: DataFrame, financials: DataFrame, use_nulls: bool) -> DataFrame:
    joined = matched.join(latest_financials(financials), "order_id", "left")
    if not use_nulls:
        joined = joined.fillna({
            "payment_method": "", "installments": 0, "discount_amount": 0.0, "tax_amount": 0.0,
            "net_amount": 0.0, "payment_status": ""})
        joined = joined.withColumn(
            "paid_at", F.coalesce("paid_at", F.lit(EPOCH_TIME).cast("timestamp")))
    return joined.select(*FACT_PURCHASES.columns)


def denormalize(events: DataFrame, orders: DataFrame, financials: DataFrame,
                count_on: DataFrame | None = None, one_per_order: bool = True,
                use_nulls: bool = False) -> DataFrame:
    """Purchases joined to their orders and payments, one wide row each.

    Orders match on user and session. With ``one_per_order`` a session's purchases shrink to
    the earliest before the join, which gives each order the row it would keep anyway and
    never builds the pairs of a session with many purchases and many orders. Without it every
    purchase of a session meets every order of it, as a plain inner join does.

    Orders without a payment row hold type defaults, or nulls with ``use_nulls``.
    ``count_on`` is passed to :func:`salted_join`.
    """
    side = purchase_side(events)
    if one_per_order:
        side = drop_duplicates(side, SESSION, order=["event_time"])
    product = orders.withColumnsRenamed(_ORDER_NAMES)
    matched = salted_join(product, side, SESSION, "inner", spread=["order_id"],
                          count_on=count_on)
    if one_per_order:
        # Keyed by order_id like the join below, so it adds no shuffle of its own.
        matched = one_row_per_order(matched)
    return _with_financials(matched, financials, use_nulls)


def facts_of(matched: DataFrame, financials: DataFrame, use_nulls: bool = False) -> DataFrame:
    """Facts of purchases that are joined to their orders already, each order once."""
    return _with_financials(one_row_per_order(matched), financials, use_nulls)


def denormalize_in_buckets(events: DataFrame, orders: OrderBuckets, financials: Callable[[], DataFrame]) -> DataFrame:
    """Like :func:`denormalize` with one row per order, for a batch of events over bucketed orders.

    Only buckets with a session of the batch are read, and only the batch is shuffled to them. Hot
    buckets go through the salted join. ``events`` are read several times: pass a stored frame.
    """
    spark = events.sparkSession
    side = drop_duplicates(purchase_side(events), SESSION, order=["event_time"]).withColumn(SLOT, orders.slot())
    hot = set(orders.hot_slots(spark))
    slots = {row[SLOT] for row in side.select(SLOT).distinct().collect()}
    matched = []
    if slots - hot:
        near = orders.read(spark, sorted(slots - hot)).withColumnsRenamed(_ORDER_NAMES)
        matched.append(near.join(side, [SLOT, *SESSION]).drop(SLOT))
    if slots & hot:
        far = orders.read(spark, sorted(slots & hot)).drop(SLOT).withColumnsRenamed(_ORDER_NAMES)
        matched.append(salted_join(far, side.drop(SLOT), SESSION, "inner", spread=["order_id"]))
    if not matched:
        return spark.createDataFrame([], FACT_PURCHASES.schema)
    rows = one_row_per_order(reduce(DataFrame.unionByName, matched))
    folder = run_dir(spark, "matched")
    rows.write.parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    return _with_financials(rows, point_filter(rows, ["order_id"])(financials()), use_nulls=False)


def orders_without_fact(orders: DataFrame, facts: DataFrame,
                        count_on: DataFrame | None = None) -> DataFrame:
    """Orders whose id is in no fact row. The ids are distinct before the anti-join."""
    return salted_join(orders, facts.select("order_id").distinct(), ["order_id"], "left_anti",
                       spread=SESSION, count_on=count_on)


def reconcile(events: DataFrame, orders: DataFrame, financials: DataFrame, facts: DataFrame,
              count_on: DataFrame | None = None) -> DataFrame:
    """The fact rows still missing: late orders, one row per order. Append the result."""
    missing = orders_without_fact(orders, facts, count_on)
    return denormalize(events, missing, financials, count_on=count_on)


def purchases_without_fact(events: DataFrame, facts: DataFrame) -> DataFrame:
    """Purchases whose session has no fact row."""
    return salted_join(purchases(events), facts.select(*SESSION).distinct(), SESSION,
                       "left_anti", spread=["kafka_partition", "kafka_offset"])
