"""Users as a base in hash buckets with a log of changes beside it, merged when they are read.

A batch of the change stream adds its own rows to the log, bucket by bucket. Readers take base rows without a
change as they are and merge the others, so the base is not shuffled while the log is small. A fold
merges the log into the base for the buckets that have grown, and writes these alone: a generation of
base buckets, and before it the list of log batches that it contains. A generation counts once it is
whole; until ``sweep`` deletes them, older generations and folded batches are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.skew import BROADCAST_BYTES, payload_bytes
from eventmart.operators.versioning import apply_changes
from eventmart.schemas import TEXT, USERS, Table
from eventmart.sources.tables import (
    BATCH, drop_folders, read_stored, stored_batches, stored_folders, write_batch)
from eventmart.streaming.changes import USER_CHANGES, start_change_log

BUCKET = "bucket"
BASE, LOG = "users_base", "users_log"
#: Which batches of the log a generation of a bucket contains.
FOLDED = Table("users_folded", T.StructType([
    T.StructField(BUCKET, T.IntegerType()), T.StructField("label", TEXT)]))


@dataclass(frozen=True)
class UserStore:
    """The folders below ``root``. The number of buckets stays what it was when the store was made."""

    spark: SparkSession
    root: str
    buckets: int = 64
    max_bytes: int = BROADCAST_BYTES

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str, label: str) -> None:
        rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).sortWithinPartitions(
            BUCKET, "user_id").write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/{name}/{BATCH}={label}")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(BATCH, TEXT), T.StructField(BUCKET, T.IntegerType())])
        if not self._labels(name):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(f"{self.root}/{name}")

    def _labels(self, name: str) -> list[str]:
        return sorted(stored_batches(self.spark, self.root, Table(name, T.StructType())))

    def start(self, records: DataFrame, checkpoint: str) -> StreamingQuery:
        """Add the changes of a stream to the log; what cannot be read goes to the dead letters."""
        return start_change_log(records, self.root, checkpoint, self.add)

    def load(self, users: DataFrame) -> None:
        """The users to begin with, as the first generation of all buckets."""
        self._fold(users, list(range(self.buckets)), {}, 0)

    def add(self, changes: DataFrame, label: str) -> None:
        """Add one batch of changes, or replace it."""
        self._write(changes.select(*USER_CHANGES.columns), LOG, label)

    def _state(self) -> tuple[dict[int, str], dict[int, set[str]]]:
        """The generation of each bucket, and the log batches that it contains."""
        current: dict[int, str] = {}
        folded: dict[int, set[str]] = {}
        whole = set(self._labels(BASE))
        rows = read_stored(self.spark, self.root, FOLDED).where(F.col(BATCH).isin(whole)).collect()
        for row in sorted(rows, key=lambda row: row[BATCH]):
            current[row[BUCKET]] = row[BATCH]
            folded.setdefault(row[BUCKET], set()).update({row.label} - {None})
        return current, folded

    def _base(self, current: dict[int, str]) -> DataFrame:
        by_generation: dict[str, list[int]] = {}
        for bucket, generation in current.items():
            by_generation.setdefault(generation, []).append(bucket)
        chosen = reduce(Column.__or__, [(F.col(BATCH) == g) & F.col(BUCKET).isin(b)
                                        for g, b in by_generation.items()], F.lit(False))
        return self._read(BASE, USERS.schema).where(chosen)

    def _log(self, folded: dict[int, set[str]]) -> DataFrame:
        """Changes that no generation contains; the conditions are on folders only."""
        done: dict[str, list[int]] = {}
        for bucket, labels in folded.items():
            for label in labels:
                done.setdefault(label, []).append(bucket)
        log = self._read(LOG, USER_CHANGES.schema)
        for label, found in done.items():
            log = log.where((F.col(BATCH) != label) | ~F.col(BUCKET).isin(found))
        return log

    def _merged(self, base: DataFrame, log: DataFrame) -> DataFrame:
        log, base = log.select(*USER_CHANGES.columns), base.select(*USERS.columns)
        changed = log.select("user_id").distinct()
        if payload_bytes(changed) > self.max_bytes:
            return apply_changes(base, log, USERS.key, USERS.version)
        changed = F.broadcast(changed)
        touched = apply_changes(base.join(changed, "user_id", "left_semi"), log, USERS.key, USERS.version)
        return base.join(changed, "user_id", "left_anti").select(*USERS.columns).unionByName(touched)

    def current(self) -> DataFrame:
        """The users with all changes applied."""
        current, folded = self._state()
        return self._merged(self._base(current), self._log(folded))

    def fold(self, least_share: float = 0.1) -> list[int]:
        """Fold the buckets whose log holds at least this share of their base's rows; returns them."""
        current, folded = self._state()
        base, log = self._base(current), self._log(folded)
        rows = base.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("changes"))
        rows = rows.unionByName(log.groupBy(BUCKET).agg(
            F.lit(0).cast("bigint").alias("rows"), F.count(F.lit(1)).alias("changes")))
        grown = rows.groupBy(BUCKET).agg(F.sum("rows").alias("rows"), F.sum("changes").alias("changes")).where(
            (F.col("changes") > 0) & (F.col("changes") >= least_share * F.col("rows")))
        chosen = sorted(row[BUCKET] for row in grown.collect())
        if chosen:
            labels = {b: folded.get(b, set()) | set(self._labels(LOG)) for b in chosen}
            number = max((int(x.rpartition("-")[2]) for x in current.values()), default=0)
            self._fold(self._merged(base.where(F.col(BUCKET).isin(chosen)), log.where(F.col(BUCKET).isin(chosen))),
                       chosen, labels, number + 1)
        return chosen

    def _fold(self, users: DataFrame, chosen: list[int], labels: dict[int, set[str]], number: int) -> None:
        generation = f"fold-{number:08d}"
        rows = [(b, label) for b in chosen for label in (labels.get(b) or [None])]
        write_batch(self.spark.createDataFrame(rows, FOLDED.schema), self.root, FOLDED, generation)
        self._write(users.select(*USERS.columns), BASE, generation)

    def sweep(self) -> int:
        """Delete folders that no reader needs: replaced buckets, and log buckets that are folded. Call it
        when no reader holds an older state; returns how many folders went."""
        current, folded = self._state()
        old = [f"{BASE}/{name}" for name in stored_folders(self.spark, f"{self.root}/{BASE}", BUCKET)
               if current.get(int(name.rpartition("=")[2])) != name.partition("/")[0].partition("=")[2]]
        old += [f"{LOG}/{name}" for name in stored_folders(self.spark, f"{self.root}/{LOG}", BUCKET)
                if name.partition("/")[0].partition("=")[2] in folded.get(int(name.rpartition("=")[2]), ())]
        drop_folders(self.spark, [f"{self.root}/{name}" for name in old])
        return len(old)
