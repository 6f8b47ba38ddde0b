"""Topics: the event stream, the users change stream and the publisher.

The Kafka connector's jar must be on the classpath; none comes with PySpark. Everything behind
the readers takes frames with the envelope's columns, so a file stream can stand in for a topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.messages import event_json
from eventmart.operators.reports import first_rows

BLOCK_ROWS = 1_048_576


def stream_options(servers: str, topic: str, max_rows: int = BLOCK_ROWS,
                   starting: str = "earliest", min_partitions: int | None = None) -> dict[str, str]:
    """Reader options. The query's checkpoint keeps the offsets, as a consumer group would. Offsets
    that are gone when the stream reaches them stop it, as is Spark's default."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic,
        "maxOffsetsPerTrigger": str(max_rows), "startingOffsets": starting,
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def envelope(records: DataFrame) -> DataFrame:
    """Records of a topic with key and value as text."""
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp")


def read_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    chosen = stream_options(servers, topic, **options)
    return envelope(spark.readStream.format("kafka").options(**chosen).load())


def keyed_messages(events: DataFrame, limit: int = 0) -> DataFrame:
    """Events as ``(key, value)``: the user id as text and the event as JSON.

    ``limit`` above 0 takes the first rows in time order.
    """
    rows = first_rows(events, limit, ["event_time", "user_id", "session_id"])
    return rows.select(F.col("user_id").cast("string").alias("key"), event_json().alias("value"))


def publish(events: DataFrame, servers: str, topic: str, limit: int = 0) -> None:
    (keyed_messages(events, limit).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
     .option("kafka.compression.type", "lz4").save())
