"""Reconcile without going through history again.

A ledger holds the orders that had no fact when the last run ended, and which batches that run had
seen. The next run takes the orders of batches written since. Those that have no fact are looked for
in all stored events, by their sessions; of the older ones the ledger knows that no event it had seen
is theirs, so they meet only the events written since. Facts added equal those of the full anti-join.

The ledger is written last. A run that is cut off changes no ledger, and the next one finds the facts
that it may have added.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from eventmart.operators.orders import product_orders_all
from eventmart.operators.purchases import (
    SESSION, denormalize, orders_without_fact, point_filter)
from eventmart.operators.versioning import latest_version
from eventmart.plans.warehouse import Warehouse
from eventmart.schemas import (
    EVENTS_ENRICHED, FACT_PURCHASES, OPEN_ORDERS, PRODUCT_TABLES, SEEN_BATCHES, Table)
from eventmart.session import run_dir
from eventmart.sources.tables import (
    drop_batches, read_batch, read_batches, stored_batches, write_batch)


@dataclass
class Run:
    """What one reconcile run did: facts added, and orders that still have none."""

    added: int
    open_orders: int


def _number(label: str) -> int:
    return int(label.removeprefix("run-"))


def _label(number: int) -> str:
    return f"run-{number:08d}"


def _staged(df: DataFrame, name: str) -> DataFrame:
    folder = run_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _unseen(batches: Mapping[str, int], mark: int, at_mark: set[str]) -> list[str]:
    return [label for label, written in batches.items()
            if written > mark or (written == mark and label not in at_mark)]


def _marks(house: Warehouse) -> tuple[int, dict[str, tuple[int, set[str]]]]:
    """The number of the last run, and per table the newest time of writing and the labels of that time
    that it saw."""
    last = max(map(_number, stored_batches(house.spark, house.root, SEEN_BATCHES)), default=0)
    marks: dict[str, tuple[int, set[str]]] = {}
    if last:
        for row in read_batch(house.spark, house.root, SEEN_BATCHES, _label(last)).collect():
            mark, labels = marks.get(row["table"], (row.written, set()))
            marks[row["table"]] = (mark, labels | {row.label})
    return last, marks


def unseen_batches(house: Warehouse, table: Table) -> list[str]:
    """Labels of a table that no run has seen."""
    return _unseen(stored_batches(house.spark, house.root, table), *_marks(house)[1].get(table.name, (0, set())))


def reconcile_new(house: Warehouse) -> Run:
    """Add the facts of orders that have none, from what was written since the last run and from
    the orders that it left open."""
    spark, root = house.spark, house.root
    last, marks = _marks(house)
    # Facts and events are listed before orders: what is written for an order that is listed here but came
    # after these two lists is in a batch that the next run takes for new.
    batches = {table.name: stored_batches(spark, root, table)
               for table in (FACT_PURCHASES, EVENTS_ENRICHED, *PRODUCT_TABLES.values())}

    def unseen(table: Table) -> DataFrame:
        labels = _unseen(batches[table.name], *marks.get(table.name, (0, set())))
        return read_batches(spark, root, table, labels)

    came = _staged(product_orders_all({line: unseen(t) for line, t in PRODUCT_TABLES.items()}), "came")
    fresh = _staged(orders_without_fact(
        came, point_filter(came, ["order_id"])(house.stored_facts())), "fresh")
    left = read_batch(spark, root, OPEN_ORDERS, _label(last)) if last else fresh.limit(0)
    older = left.join(unseen(FACT_PURCHASES).select("order_id").distinct(), "order_id", "left_anti")
    wanted = latest_version(fresh.unionByName(older), OPEN_ORDERS.key, OPEN_ORDERS.version)
    ids = fresh.select("order_id").distinct()
    fresh = _staged(wanted.join(ids, "order_id", "left_semi"), "fresh")
    older = _staged(wanted.join(ids, "order_id", "left_anti"), "older")

    def facts(orders: DataFrame, events: DataFrame) -> DataFrame:
        return denormalize(point_filter(orders, SESSION)(events), orders,
                           point_filter(orders, ["order_id"])(house.financials()))

    label = f"fill-{uuid.uuid4().hex}"
    write_batch(facts(fresh, house.events()).unionByName(facts(older, unseen(EVENTS_ENRICHED))),
                root, FACT_PURCHASES, label)
    added = read_batch(spark, root, FACT_PURCHASES, label).select("order_id")
    still = fresh.unionByName(older).join(added, "order_id", "left_anti")
    write_batch(still, root, OPEN_ORDERS, _label(last + 1))
    rows = [(name, found, written) for name, known in batches.items()
            for found, written in known.items() if written == max(known.values())]
    write_batch(spark.createDataFrame(rows, SEEN_BATCHES.schema), root, SEEN_BATCHES, _label(last + 1))
    drop_batches(spark, root, SEEN_BATCHES, [_label(last - 1)])
    drop_batches(spark, root, OPEN_ORDERS, [_label(last - 1)])
    return Run(added.count(), read_batch(spark, root, OPEN_ORDERS, _label(last + 1)).count())
