"""What the engine itself says of its streams: rows per micro-batch and source, stored beside the data.

The listener is called from the engine's own thread, so it only keeps what it is told; ``store`` writes the
rows, as often as a service likes and once a query has ended. Offsets of topics unfold into partitions,
so that a stream's position and its lag come from the same rows as its counts.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventmart.schemas import PROGRESS
from eventmart.sources.tables import read_table, write_batch
from eventmart.streaming.live import wait

#: Offsets of a topic: partition by partition below its name.
OFFSETS = "map<string,map<string,bigint>>"


class ProgressLog(StreamingQueryListener):
    """Rows per batch and source of all queries of a session, from ``attach`` on."""

    def __init__(self) -> None:
        super().__init__()
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._lock = threading.Condition()

    def attach(self, spark: SparkSession) -> ProgressLog:
        spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        with self._lock:
            for place, source in enumerate(told.sources):
                self._rows.append((
                    str(told.id), told.batchId, place, told.timestamp, source.description,
                    source.numInputRows, source.endOffset, source.latestOffset))

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait(self, query: StreamingQuery, seconds: float) -> None:
        """Wait until a query over available data is done and the last of its batches has been told of."""
        wait(query, seconds)
        with self._lock:
            if not self._lock.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no word of the query's end within {seconds} seconds")

    def store(self, spark: SparkSession, root: str) -> int:
        """Write the rows kept so far and forget them; returns how many. They stay kept if that fails."""
        with self._lock:
            rows = list(self._rows)
        if rows:
            frame = spark.createDataFrame(rows, PROGRESS.schema)
            write_batch(frame, root, PROGRESS, uuid.uuid4().hex)
            with self._lock:
                del self._rows[:len(rows)]
        return len(rows)


def batch_progress(spark: SparkSession, root: str) -> DataFrame:
    """Each batch of each query once, with the rows it read from all sources; a batch that ran again after
    a failure is told of twice, and its last word counts."""
    rows = read_table(spark, root, PROGRESS)
    last = rows.groupBy("query", "batch_id", "source").agg(
        F.max_by("input_rows", "told_at").alias("input_rows"), F.max("told_at").alias("told_at"))
    return last.groupBy("query", "batch_id").agg(
        F.sum("input_rows").alias("input_rows"), F.max("told_at").alias("told_at"))


def topic_lag(progress: DataFrame) -> DataFrame:
    """Position and lag by topic and partition, from each query's newest rows; sources that are no topics have
    no offsets by partition and are left out."""
    newest = progress.groupBy("query", "source").agg(F.max_by(
        F.struct("end_offset", "latest_offset"), F.struct("batch_id", "told_at")).alias("x"))
    ends = newest.select("query", F.col("x.latest_offset").alias("latest"), F.explode(
        F.from_json("x.end_offset", OFFSETS)).alias("topic", "offsets")).select(
        "query", "topic", "latest", F.explode("offsets").alias("partition", "end_offset"))
    latest = F.from_json("latest", OFFSETS)
    return ends.where("end_offset IS NOT NULL").select(
        "query", "topic", F.col("partition").cast("int").alias("partition"), "end_offset",
        F.element_at(F.element_at(latest, F.col("topic")), F.col("partition")).alias("latest_offset")).withColumn(
        "lag", F.greatest(F.coalesce("latest_offset", "end_offset") - F.col("end_offset"), F.lit(0)))
