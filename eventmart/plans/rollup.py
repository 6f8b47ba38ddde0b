"""The revenue per product line and day, kept as a stored table of changes.

Reading sums the changes. A refresh counts the batches of facts written since the last one. An order may
be in several batches, and only its earliest purchase counts, so a refresh looks up the orders of
the new batches among those counted before, and stores the difference between the order's share with and
without the new rows: what moves to another day is taken back where it was. Erasure takes its subjects'
shares back before their facts go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.numbers import money
from eventmart.functions.times import day_start
from eventmart.operators.purchases import point_filter
from eventmart.operators.versioning import one_row_per_order
from eventmart.plans.warehouse import Warehouse
from eventmart.schemas import COUNTED_BATCHES, FACT_PURCHASES, REVENUE_CHANGES
from eventmart.session import run_dir
from eventmart.sources.tables import (
    BATCH, erase_subjects, read_batches, read_stored, read_table, stored_batches, write_batch)

SHARE = ("order_id", "event_time", "user_id", "session_id", "product_line", "net_amount")


def _shares(facts: DataFrame, sign: int) -> DataFrame:
    """What each order adds to a line and day, or takes away."""
    return one_row_per_order(facts.select(*SHARE)).select(
        "product_line", F.to_date(day_start("event_time")).alias("day"),
        (F.coalesce(money("net_amount"), F.lit(0)) * sign).cast("decimal(38,2)").alias("revenue"),
        F.lit(sign).cast("bigint").alias("orders"))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy("product_line", "day").agg(
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"), F.sum("orders").alias("orders"))


def _difference(after: DataFrame, before: DataFrame) -> DataFrame:
    """Changes that lead from the shares of ``before`` to those of ``after``, without rows of nothing."""
    return _summed(_shares(after, 1).unionAll(_shares(before, -1))).where("revenue <> 0 OR orders <> 0")


def uncounted_batches(house: Warehouse) -> list[str]:
    """Labels of the batches of facts that no refresh has counted."""
    counted = {row.label for row in read_table(house.spark, house.root, COUNTED_BATCHES).collect()}
    return [label for label in stored_batches(house.spark, house.root, FACT_PURCHASES) if label not in counted]


def refresh(house: Warehouse) -> int:
    """Count the batches of facts that are not counted yet; returns how many there were.

    A refresh that was cut off is done again under the same label, and replaces what it wrote.
    """
    spark, root = house.spark, house.root
    new = uncounted_batches(house)
    if not new:
        return 0
    folder = run_dir(spark, "counting")
    read_batches(spark, root, FACT_PURCHASES, new).select(*SHARE).write.parquet(folder)
    came = spark.read.parquet(folder)
    known = read_stored(spark, root, FACT_PURCHASES).where(~F.col(BATCH).isin(new)).select(*SHARE)
    before = point_filter(came, ["order_id"])(known)
    number = len(stored_batches(spark, root, COUNTED_BATCHES)) + 1
    write_batch(_difference(came.unionAll(before), before), root, REVENUE_CHANGES, f"run-{number:08d}")
    write_batch(spark.createDataFrame([(label,) for label in new], COUNTED_BATCHES.schema), root,
                COUNTED_BATCHES, f"run-{number:08d}")
    return len(new)


def erase(house: Warehouse, subjects: DataFrame, request: str) -> None:
    """Take back what some users' facts add, then remove these facts.

    ``request`` names the erasure. One that was cut off is repeated under its name: what it took back
    stands, and the facts go.
    """
    spark, root = house.spark, house.root
    refresh(house)
    label = f"erase-{request}"
    if label not in stored_batches(spark, root, REVENUE_CHANGES):
        facts = house.stored_facts().select(*SHARE)
        hit = facts.join(subjects.select("user_id"), "user_id", "left_semi").select("order_id").distinct()
        folder = run_dir(spark, "erasing")
        facts.join(hit, "order_id", "left_semi").write.parquet(folder)
        touched = spark.read.parquet(folder)
        rest = touched.join(subjects.select("user_id"), "user_id", "left_anti").select(*SHARE)
        write_batch(_difference(rest, touched.select(*SHARE)), root, REVENUE_CHANGES, label)
    erase_subjects(spark, root, FACT_PURCHASES, subjects)


def revenue(house: Warehouse, since: str | Column | None = None) -> DataFrame:
    """Revenue and orders per line and day, from the day of ``since`` on."""
    changes = read_table(house.spark, house.root, REVENUE_CHANGES)
    if since is not None:
        changes = changes.where(F.col("day") >= F.to_date(F.lit(since) if isinstance(since, str) else since))
    return _summed(changes).where("orders <> 0").select(
        "product_line", "day", F.col("revenue").cast("double").alias("revenue"), "orders")
