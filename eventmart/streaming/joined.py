"""Purchases and orders joined while both arrive, in whatever order they come.

The join keeps rows of both streams in its state until no row that may still come can match them: until
the watermark, which trails the slower stream's newest time by ``delay``, has passed them by
the bounds between a purchase and its orders. A row that comes later than that is dropped here
and left to the reconcile job, which looks at stored tables and knows no lateness.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.purchases import facts_of, key_filter, purchase_side
from eventmart.schemas import FACT_PURCHASES
from eventmart.session import run_dir
from eventmart.sources.tables import batch_label, write_batch

#: State of many rows belongs on the executors' disks and not in their heaps.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class OrderJoin:
    """Where the facts go, how payments are read, and how far rows of one session may lie apart.

    ``before`` and ``after`` bound an order's time around its purchase's; they bound the state too.
    """

    root: str
    financials: Callable[[], DataFrame]
    delay: str = "1 day"
    before: str = "1 hour"
    after: str = "1 hour"

    def matched(self, events: DataFrame, orders: DataFrame) -> DataFrame:
        """The inner join of two streams: enriched events, and orders in the unified shape."""
        side = purchase_side(events).withColumnsRenamed(
            {"user_id": "_user", "session_id": "_session"}).withWatermark("event_time", self.delay)
        product = orders.withColumnsRenamed({
            "premium": "order_premium", "created_at": "order_created_at"}).withWatermark(
            "order_created_at", self.delay)
        return side.join(product, F.expr(
            f"user_id = _user AND session_id = _session"
            f" AND order_created_at >= event_time - INTERVAL {self.before}"
            f" AND order_created_at <= event_time + INTERVAL {self.after}")).drop("_user", "_session")

    def store(self, matched: DataFrame, batch_id: int) -> None:
        """Facts of the matches of one batch. Each order keeps its earliest purchase of the batch;
        copies from other batches are told apart when facts are read."""
        spark = matched.sparkSession
        folder = run_dir(spark, "matched")
        matched.write.parquet(folder)
        matched = spark.read.schema(matched.schema).parquet(folder)
        paid = key_filter(matched, ["order_id"])(self.financials())
        write_batch(facts_of(matched, paid), self.root, FACT_PURCHASES, batch_label(spark, batch_id))

    def start(self, events: DataFrame, orders: DataFrame, checkpoint: str,
              every: str | None = None) -> StreamingQuery:
        """Start the query: over what is there now, or every so often. The state's provider is fixed
        by the checkpoint's first run."""
        spark = events.sparkSession
        known = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        try:
            writer = self.matched(events, orders).writeStream.outputMode("append").foreachBatch(
                self.store).option("checkpointLocation", checkpoint)
            return (writer.trigger(processingTime=every) if every
                    else writer.trigger(availableNow=True)).start()
        finally:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", known)


def state_counts(progress: Sequence) -> tuple[int, int]:
    """Of a query's progress: rows dropped as too late, and rows its state holds at the end."""
    dropped = held = 0
    for batch in progress:
        for operator in batch["stateOperators"]:
            dropped += operator["numRowsDroppedByWatermark"]
            held = operator["numRowsTotal"]
    return dropped, held


def append(df: DataFrame, folder: str) -> None:
    """Add rows to a folder that streams read."""
    df.write.mode("append").parquet(folder)


def folder_stream(spark: SparkSession, like: DataFrame, folder: str) -> DataFrame:
    """A folder of Parquet files as a stream with the columns of ``like``."""
    return spark.readStream.schema(like.schema).parquet(folder)
