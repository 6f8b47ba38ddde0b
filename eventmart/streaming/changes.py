"""The users table kept current from its change stream.

Changes are stored batch by batch next to the base table and folded in when users are read.
A batch costs its own rows only; ``fold`` writes a new base when the log has grown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators.versioning import apply_changes
from eventmart.schemas import DEAD_LETTERS, USERS, Table
from eventmart.sources.tables import batch_label, read_table, write_batch
from eventmart.streaming.records import change_dead_letters, parse_changes

USER_CHANGES = Table(
    "users_changes",
    T.StructType([*USERS.schema.fields, T.StructField("_position", T.LongType()),
                  T.StructField("_deleted", T.BooleanType())]),
    key=USERS.key, version=USERS.version, sort=("user_id",))


def start_change_log(records: DataFrame, root: str, checkpoint: str,
                     add: Callable[[DataFrame, str], None] | None = None) -> StreamingQuery:
    """Store the changes of a stream, and what cannot be read as one among the dead letters. ``add``
    takes a batch's changes and label to another place than the plain log."""
    def store(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(batch.sparkSession, batch_id)
        write_batch(change_dead_letters(batch), root, DEAD_LETTERS, label)
        if add:
            add(parse_changes(batch), label)
        else:
            write_batch(parse_changes(batch), root, USER_CHANGES, label)

    return (records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_users(spark: SparkSession, root: str) -> DataFrame:
    """The base table with all stored changes applied."""
    return apply_changes(read_table(spark, root, USERS), read_table(spark, root, USER_CHANGES),
                         USERS.key, USERS.version)


def fold(spark: SparkSession, root: str, new_root: str) -> None:
    """Write the current users as the base of a fresh root."""
    write_batch(current_users(spark, root), new_root, USERS, "base")
