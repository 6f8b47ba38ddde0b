"""Orders of all lines in hash buckets of their session, beside the tables they come from.

The table is a bucketed Parquet table. A session falls into a slot, and Spark's own hash of the slot
names the bucket file. A join on slot, user and session takes the buckets as they are, so orders are
not shuffled for it, nor for their latest versions; a filter on a batch's slots, of which there are
no more than ``slots``, opens only the buckets that hold them.

Buckets far above the others, which a hot session makes, are left out of that and joined with salts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.versioning import latest_version
from eventmart.schemas import OPEN_ORDERS
from eventmart.sources.tables import _files

SLOT = "slot"
#: A bucket is hot from this size on, if it is also so many times the mean.
HOT_BYTES, HOT_TIMES = 1 << 30, 4


@dataclass(frozen=True)
class OrderBuckets:
    """The bucketed table below ``root``. Its number of buckets stays what it was when it was made."""

    root: str
    buckets: int = 64
    per_bucket: int = 16
    hot_bytes: int = HOT_BYTES

    @property
    def slots(self) -> int:
        return self.buckets * self.per_bucket

    @property
    def path(self) -> str:
        return f"{self.root}/orders_by_session"

    @property
    def name(self) -> str:
        return f"orders_by_session_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"

    def slot(self) -> Column:
        return F.pmod(F.xxhash64("user_id", "session_id"), F.lit(self.slots)).cast("int")

    def bucket(self) -> Column:
        """The bucket that Spark writes a slot to."""
        return F.pmod(F.hash(SLOT), F.lit(self.buckets))

    def attach(self, spark: SparkSession) -> None:
        """Make the table known to a session's catalog; its files stay where they are. A join on more
        keys than the bucket's column may use the buckets."""
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in OPEN_ORDERS.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({fields}, {SLOT} int) USING parquet "
                  f"CLUSTERED BY ({SLOT}) SORTED BY ({SLOT}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        spark.catalog.refreshTable(self.name)

    def add(self, orders: DataFrame) -> None:
        """Add orders in the unified shape. Rows that are added twice are one version, so a write may be
        repeated; ``rebalance`` splits what a hot session brings."""
        self.attach(orders.sparkSession)
        orders.select(*OPEN_ORDERS.columns, self.slot().alias(SLOT)).hint("rebalance", SLOT).write.insertInto(self.name)

    def hot_slots(self, spark: SparkSession) -> list[int]:
        """Slots of hot buckets, from the sizes of the files; none as a rule."""
        files, path = _files(spark, self.path)
        sizes = [0] * self.buckets
        for f in files.globStatus(path(f"{self.path}/part-*")) or []:
            # Spark ends a bucket file's name with an underscore and the bucket's number.
            sizes[int(f.getPath().getName().split(".")[0].rpartition("_")[2])] += f.getLen()
        most = max(self.hot_bytes, HOT_TIMES * sum(sizes) / self.buckets)
        hot = [i for i, size in enumerate(sizes) if size > most]
        if not hot:
            return []
        rows = spark.range(self.slots).select(F.col("id").cast("int").alias(SLOT)).where(self.bucket().isin(hot))
        return [row[SLOT] for row in rows.collect()]

    def read(self, spark: SparkSession, slots: Sequence[int] | None = None) -> DataFrame:
        """Orders at their latest versions, with their slot: all, or those of some slots."""
        self.attach(spark)
        rows = spark.table(self.name)
        if slots is not None:
            rows = rows.where(F.col(SLOT).isin(list(slots)))
        # The slot follows from the session; naming it lets the window use the buckets.
        return latest_version(rows, [SLOT, *OPEN_ORDERS.key], OPEN_ORDERS.version)
