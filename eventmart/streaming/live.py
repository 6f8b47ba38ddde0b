"""The live pipeline: one streaming query that fills four tables per micro-batch.

Each output is written under the stream's id and the batch's number. A batch that runs again
replaces what it wrote, so nothing counts twice, although the stream delivers at least once; a
stream with another checkpoint has another id and adds to what is there.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.aggregates import daily_states, lag_states
from eventmart.operators.enrich import USER_COLUMNS, enrich
from eventmart.operators.orders import product_orders_all
from eventmart.operators.purchases import (
    SESSION, denormalize, denormalize_in_buckets, key_filter, purchases)
from eventmart.operators.skew import BROADCAST_BYTES, payload_bytes
from eventmart.schemas import (
    CONSUMED, DEAD_LETTERS, EVENTS_AGG_DAILY, EVENTS_ENRICHED, FACT_PURCHASES, LAG_STATES, USER_EVENTS)
from eventmart.session import run_dir
from eventmart.sources.buckets import OrderBuckets
from eventmart.sources.tables import batch_label, read_batch, read_table, write_batch
from eventmart.streaming.records import (
    dead_letters, first_deliveries, good_events, parse_records)

REFRESH_SECONDS = 300


@dataclass
class Refreshed:
    """A table that is read again once its copy is older than ``seconds``.

    The copy is written to the shared folder, so batches read its rows and do not derive them
    again; two folders take turns, so no more than two copies exist. Its size is measured when
    it is read, not per batch, and decides whether joins to it may broadcast.
    """

    load: Callable[[], DataFrame]
    seconds: float = REFRESH_SECONDS
    clock: Callable[[], float] = time.monotonic
    max_bytes: int = BROADCAST_BYTES
    _frame: DataFrame | None = field(default=None, init=False)
    _small: bool = field(default=False, init=False)
    _read_at: float = field(default=0.0, init=False)
    _folders: list[str] = field(default_factory=list, init=False)

    def get(self) -> tuple[DataFrame, bool]:
        now = self.clock()
        if self._frame is None or now - self._read_at >= self.seconds:
            self._frame = self._copy(self.load())
            self._small = payload_bytes(self._frame.select(*USER_COLUMNS)) <= self.max_bytes
            self._read_at = now
        return self._frame, self._small

    def _copy(self, frame: DataFrame) -> DataFrame:
        spark = frame.sparkSession
        if not self._folders:
            self._folders = [run_dir(spark, "lookup") for _ in range(2)]
        self._folders.reverse()
        frame.write.mode("overwrite").parquet(self._folders[0])
        return spark.read.schema(frame.schema).parquet(self._folders[0])


@dataclass
class LivePipeline:
    """Where the stream's tables live and how its lookups are read.

    ``products`` and ``financials`` are called once per batch. Each batch sees the orders present
    when it runs; what arrives later is left to the reconcile job. With ``order_buckets`` orders come
    from there, and a batch opens only the buckets of its sessions. With ``redelivery``, a time such as
    "1 hour", messages that come again within it never reach the tables. With ``lag_sketches`` each batch
    adds sketches of its ingest lags.
    """

    root: str
    users: Refreshed
    products: Callable[[], Mapping[str, DataFrame]] | None = None
    financials: Callable[[], DataFrame] | None = None
    ingested_at: Callable[[], str | Column | None] = lambda: None
    order_buckets: OrderBuckets | None = None
    redelivery: str | None = None
    lag_sketches: bool = False

    def process(self, records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        label = batch_label(spark, batch_id)
        parsed = parse_records(records).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(dead_letters(parsed), self.root, DEAD_LETTERS, label)
            users, small = self.users.get()
            rows = enrich(good_events(parsed), users, self.ingested_at(), broadcast=small)
            write_batch(rows, self.root, EVENTS_ENRICHED, label)
            # Of the parsed rows, which are kept: the source is read once.
            write_batch(batch_counts(parsed), self.root, CONSUMED, label)
        finally:
            parsed.unpersist()
        # The batch's rows are read back from its files, so neither parsing nor the lookup
        # runs again for the outputs below, and a lost executor does not redo them.
        stored = read_batch(spark, self.root, EVENTS_ENRICHED, label)
        write_batch(daily_states(stored), self.root, EVENTS_AGG_DAILY, label)
        if self.lag_sketches:
            write_batch(lag_states(stored), self.root, LAG_STATES, label)
        if self.order_buckets and self.financials:
            write_batch(denormalize_in_buckets(stored, self.order_buckets, self.financials), self.root,
                        FACT_PURCHASES, label)
        elif self.products and self.financials:
            self._write_facts(stored, label)

    def _write_facts(self, stored: DataFrame, label: str) -> None:
        """Facts of one batch. The order tables shrink to the batch's sessions while they are
        scanned, before versions are compared, so no batch shuffles a whole table."""
        bought = purchases(stored)
        if bought.isEmpty():
            return
        of_batch = key_filter(bought, SESSION)
        narrowed = {line: of_batch(table) for line, table in self.products().items()}
        orders = product_orders_all(narrowed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            paid = key_filter(orders, ["order_id"])(self.financials())
            write_batch(denormalize(stored, orders, paid), self.root, FACT_PURCHASES, label)
        finally:
            orders.unpersist()

    def start(self, records: DataFrame, checkpoint: str, every: str | None = None,
              name: str | None = None) -> StreamingQuery:
        """Start the query: over what is there now, or every so often, such as "10 seconds"."""
        if self.redelivery:
            records = first_deliveries(records, self.redelivery)
        writer = records.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        writer = writer.trigger(processingTime=every) if every else writer.trigger(
            availableNow=True)
        return writer.start()


def wait(query: StreamingQuery, seconds: float) -> None:
    """Wait until a query over available data is done; stop it and raise if it takes longer."""
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream not consumed within {seconds} seconds")


def start_raw_sink(records: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Add the good events of a stream to a raw table below ``root``, without enrichment, and the
    others to its dead letters."""
    def store(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch.sparkSession, batch_id)
        parsed = parse_records(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(dead_letters(parsed), root, DEAD_LETTERS, label)
            write_batch(good_events(parsed).select(*USER_EVENTS.columns), root, USER_EVENTS, label)
            write_batch(batch_counts(parsed), root, CONSUMED, label)
        finally:
            parsed.unpersist()

    return (records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def batch_counts(batch: DataFrame) -> DataFrame:
    """Messages of a batch by topic and partition, with the last offset."""
    return batch.groupBy("topic", "partition").agg(
        F.count("*").alias("num_messages_read"), F.max("offset").alias("last_offset"))


def consumer_totals(spark: SparkSession, root: str) -> DataFrame:
    """Messages that all batches of all streams have read, by topic and partition."""
    return read_table(spark, root, CONSUMED).groupBy("topic", "partition").agg(
        F.sum("num_messages_read").alias("num_messages_read"),
        F.max("last_offset").alias("last_offset"))
