"""Jobs over a stored warehouse: seed, ingest, reconcile, verify, gate, and their chains."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from eventmart.operators import quality
from eventmart.operators.monitoring import partition_progress
from eventmart.operators.purchases import SESSION, denormalize, key_filter, orders_without_fact
from eventmart.operators.reports import verification_report
from eventmart.plans import rollup
from eventmart.plans.ledger import reconcile_new, unseen_batches
from eventmart.plans.warehouse import Warehouse
from eventmart.schemas import (
    CONSUMED, DATA_TABLES, DEAD_LETTERS, EVENTS_ENRICHED, FACT_PURCHASES, FINANCIAL_ORDER, PRODUCT_TABLES,
    Table)
from eventmart.session import run_dir
from eventmart.sources.files import read_csv
from eventmart.sources.tables import compact_months, read_batch, truncate, write_batch
from eventmart.streaming.live import LivePipeline, Refreshed, wait


def reset(house: Warehouse) -> None:
    """Empty all data tables; users stay. The next stream needs a new checkpoint folder."""
    truncate(house.spark, house.root, [*DATA_TABLES, DEAD_LETTERS, CONSUMED])


def seed_products(house: Warehouse, products: Mapping[str, DataFrame], label: str) -> None:
    for line, table in PRODUCT_TABLES.items():
        write_batch(products[line], house.root, table, label)


def seed(house: Warehouse, products: Mapping[str, DataFrame], financials: DataFrame,
         label: str = "seed") -> None:
    """Add rows to the five order tables, or replace those seeded under the same label."""
    seed_products(house, products, label)
    write_batch(financials, house.root, FINANCIAL_ORDER, label)


def load_csv(house: Warehouse, path: str, table, label: str) -> None:
    """Add a headered CSV file or folder to a table."""
    write_batch(read_csv(house.spark, path, table.schema), house.root, table, label)


def denormalize_stored(house: Warehouse, label: str = "stored") -> None:
    """Facts of all stored purchases in one go, as one replaceable batch."""
    facts = denormalize(house.events(), house.orders(), house.financials(),
                        count_on=house.order_keys())
    write_batch(facts, house.root, FACT_PURCHASES, label)


def reconcile(house: Warehouse) -> int:
    """Add the facts of orders that have none yet, over all that is stored; returns how many were
    added. Runs that repeat every few minutes use ``ledger.reconcile_new``.

    The missing orders are stored first. They are few as a rule, which is then known before
    the join is planned: it can do without a shuffle of all purchases.
    """
    staged = run_dir(house.spark, "missing-orders")
    missing = orders_without_fact(
        house.orders(), house.stored_facts(),
        count_on=house.order_keys())
    missing.write.parquet(staged)
    missing = house.spark.read.schema(missing.schema).parquet(staged)
    facts = denormalize(key_filter(missing, SESSION)(house.events()), missing,
                        key_filter(missing, ["order_id"])(house.financials()))
    label = f"fill-{uuid.uuid4().hex}"
    write_batch(facts, house.root, FACT_PURCHASES, label)
    return read_batch(house.spark, house.root, FACT_PURCHASES, label).count()


def compact(house: Warehouse, table: Table, months: Sequence[int], keep: Iterable[str] = (),
            merge: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
    """Fold the batches of some months of a table in place; returns how many files were replaced. Batches that
    the reconcile ledger or the revenue rollup have not seen stay, as do those to ``keep``."""
    held = set(keep)
    if table in (FACT_PURCHASES, EVENTS_ENRICHED, *PRODUCT_TABLES.values()):
        held.update(unseen_batches(house, table))
    if table is FACT_PURCHASES:
        held.update(rollup.uncounted_batches(house))
    return compact_months(house.spark, house.root, table, months, held, merge)


def live_pipeline(house: Warehouse, refresh_seconds: float = 300,
                  ingested_at: str | Column | None = None) -> LivePipeline:
    """The stream's pipeline over a warehouse."""
    return LivePipeline(house.root, Refreshed(house.users, refresh_seconds),
                        house.product_tables, house.financials, lambda: ingested_at)


def ingest(house: Warehouse, records: DataFrame, checkpoint: str, seconds: float = 120,
           ingested_at: str | Column | None = None) -> None:
    """Take in everything a stream holds now; raises if that takes longer than ``seconds``."""
    pipeline = live_pipeline(house, ingested_at=ingested_at)
    wait(pipeline.start(records, checkpoint), seconds)


def verify(house: Warehouse) -> Mapping[str, DataFrame]:
    return verification_report(house.users(), house.events(), house.daily(), house.facts())


def gate(house: Warehouse, expected: int, as_of: str | None = None,
         fail_on_dead_letters: bool = False) -> quality.GateResult:
    events = house.events()
    dead = house.dead_letters() if fail_on_dead_letters else None
    return quality.run_gate(quality.checks(
        events, house.facts(), partition_progress(events), expected, as_of, dead))


def monitoring(house: Warehouse, expected: int, as_of: str | None = None) -> quality.GateResult:
    """Reconcile what came since the last time, then the gate."""
    reconcile_new(house)
    return gate(house, expected, as_of)


def ingest_cycle(house: Warehouse, records: DataFrame, checkpoint: str, expected: int,
                 seconds: float = 120, as_of: str | None = None) -> quality.GateResult:
    """Ingest what the stream holds, reconcile, then the gate."""
    ingest(house, records, checkpoint, seconds, as_of)
    return monitoring(house, expected, as_of)


def full_run(house: Warehouse, products: Mapping[str, DataFrame], financials: DataFrame,
             records: DataFrame, checkpoint: str, seconds: float = 120,
             ingested_at: str | Column | None = None) -> Mapping[str, DataFrame]:
    """Reset, seed the orders, ingest, reconcile and report."""
    reset(house)
    seed(house, products, financials)
    ingest(house, records, checkpoint, seconds, ingested_at)
    reconcile(house)
    return verify(house)

