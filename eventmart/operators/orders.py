"""Order tables: derivation from purchases and the unified view over them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.numbers import number_text, price_parts
from eventmart.functions.routing import stable_line
from eventmart.functions.values import PRODUCT_LINES, PURCHASE
from eventmart.operators.versioning import latest_version
from eventmart.schemas import FINANCIAL_ORDER, PRODUCT_TABLES

ORDER_COLUMNS = ("order_id", "user_id", "session_id", "premium", "created_at")


def lineage_order_id(partitions: int) -> Column:
    """An order id that is unique and stays the same when a stream is read again."""
    return F.col("kafka_offset") * partitions + F.col("kafka_partition") + 1


def orders_from_purchases(events: DataFrame, order_id: Column) -> DataFrame:
    """One order per purchase with its product line; a missing premium is 0."""
    return (events.filter(F.col("event_type") == PURCHASE)
            .select(order_id.cast("bigint").alias("order_id"), "user_id", "session_id",
                    F.coalesce("premium_amount", F.lit(0.0)).alias("premium"),
                    F.col("event_time").alias("created_at"))
            .withColumn("product_line", stable_line("user_id", "session_id")))


def split_by_line(orders: DataFrame) -> dict[str, DataFrame]:
    """The orders of each line; the four together are all orders."""
    return {line: orders.filter(F.col("product_line") == line).drop("product_line")
            for line in PRODUCT_LINES}


def financial_rows(orders: DataFrame, rate: Column, **fields: Column) -> DataFrame:
    """Exactly one payment row per order, priced from its premium and discount rate.

    ``fields`` gives payment_method, installments and payment_status.
    """
    parts = price_parts("premium", rate)
    priced = orders.select(
        "order_id", *[value.alias(name) for name, value in fields.items()],
        *[value.cast("double").alias(name) for name, value in parts.items()],
        F.col("created_at").alias("paid_at"))
    return priced.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in FINANCIAL_ORDER.schema.fields])


def line_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_line").agg(F.count(F.lit(1)).alias("orders"))


def _attribute_map(line: str) -> str:
    """SQL for the columns only this line has, as a map of texts."""
    pairs = []
    for f in PRODUCT_TABLES[line].schema.fields[len(ORDER_COLUMNS):]:
        fraction = isinstance(f.dataType, (T.DoubleType, T.DecimalType))
        text = number_text(f.name) if fraction else f"cast(`{f.name}` as string)"
        pairs.append(f"'{f.name}', {text}")
    return f"map({', '.join(pairs)})"


def product_orders_all(tables: Mapping[str, DataFrame], collapse: bool = True) -> DataFrame:
    """Union of the product tables with the line's own attributes as a string map.

    The tables are read at their latest versions; ``collapse=False`` reads all versions. The
    typed columns stay side by side until then, so that one shuffle serves the four tables and
    equal versions are told apart by typed values.
    """
    parts = [tables[line].select(*table.columns, F.lit(line).alias("product_line"))
             for line, table in PRODUCT_TABLES.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if collapse:
        rows = latest_version(rows, ["user_id", "session_id", "order_id", "product_line"],
                              "created_at")
    maps = " ".join(f"when '{line}' then {_attribute_map(line)}" for line in PRODUCT_TABLES)
    return rows.select(*ORDER_COLUMNS, "product_line",
                       F.expr(f"case product_line {maps} end").alias("attributes"))


def order_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of all stored order rows, a cheap scan that tells where the hot keys are."""
    return reduce(DataFrame.unionByName,
                  [tables[line].select("user_id", "session_id", "order_id")
                   for line in PRODUCT_TABLES])


def latest_financials(financials: DataFrame) -> DataFrame:
    return latest_version(financials.select(*FINANCIAL_ORDER.columns), FINANCIAL_ORDER.key,
                          FINANCIAL_ORDER.version)
