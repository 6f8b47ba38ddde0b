"""The stored tables of one warehouse, as frames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from eventmart.operators.aggregates import finalize_states
from eventmart.operators.orders import order_keys, product_orders_all
from eventmart.operators.versioning import one_row_per_order
from eventmart.schemas import (
    DEAD_LETTERS, EVENTS_AGG_DAILY, EVENTS_ENRICHED, FACT_PURCHASES, FINANCIAL_ORDER, PRODUCT_TABLES, USERS)
from eventmart.sources.tables import read_table
from eventmart.streaming.changes import current_users


@dataclass
class Warehouse:
    """The tables below one root folder, as frames.

    With ``change_log`` the users are the base table with the stored changes applied.
    """

    spark: SparkSession
    root: str
    change_log: bool = False

    def events(self) -> DataFrame:
        return read_table(self.spark, self.root, EVENTS_ENRICHED)

    def daily(self) -> DataFrame:
        return finalize_states(read_table(self.spark, self.root, EVENTS_AGG_DAILY))

    def stored_facts(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Facts as stored. Copies of an event in two batches leave its order there twice."""
        return read_table(self.spark, self.root, FACT_PURCHASES, start, end)

    def facts(self) -> DataFrame:
        """Facts with each order once."""
        return one_row_per_order(self.stored_facts())

    def users(self) -> DataFrame:
        if self.change_log:
            return current_users(self.spark, self.root)
        return read_table(self.spark, self.root, USERS)

    def product_tables(self, start: str | None = None) -> Mapping[str, DataFrame]:
        return {line: read_table(self.spark, self.root, table, start)
                for line, table in PRODUCT_TABLES.items()}

    def orders(self) -> DataFrame:
        return product_orders_all(self.product_tables())

    def order_keys(self) -> DataFrame:
        return order_keys(self.product_tables())

    def financials(self, start: str | None = None) -> DataFrame:
        return read_table(self.spark, self.root, FINANCIAL_ORDER, start)

    def dead_letters(self) -> DataFrame:
        return read_table(self.spark, self.root, DEAD_LETTERS)
