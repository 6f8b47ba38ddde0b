"""Latest versions, duplicates and changes.

Each "first row per key" is a ``row_number() = 1`` filter. Spark places a group limit before
the shuffle for it, so a map task sends at most one row per key, and a key that holds a
large part of the table costs no reducer more than one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _remaining(df: DataFrame, used: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))]


def ascending(names: Sequence[str]) -> list[str]:
    return [f"`{name}` ASC NULLS LAST" for name in names]


def descending(names: Sequence[str]) -> list[str]:
    return [f"`{name}` DESC NULLS LAST" for name in names]


def _maps(df: DataFrame, direction: str) -> list[str]:
    """Sort terms of map columns: their entries in order of keys, as text."""
    return [f"CAST(array_sort(map_entries(`{f.name}`)) AS STRING) {direction} NULLS LAST"
            for f in df.schema.fields if isinstance(f.dataType, T.MapType)]


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``, a list of SQL sort terms."""
    keys = ", ".join(f"`{name}`" for name in key)
    row = F.expr(f"row_number() OVER (PARTITION BY {keys} ORDER BY {', '.join(order)})")
    return df.withColumn("_row", row).filter("_row = 1").drop("_row")


def drop_duplicates(df: DataFrame, key: Sequence[str],
                    order: Sequence[str] = ()) -> DataFrame:
    """One row per natural key. All other columns break ties, so reruns keep the same row."""
    return keep_first(df, key, [
        *ascending([*order, *_remaining(df, [*key, *order])]), *_maps(df, "ASC")] or ["1"])


def latest_version(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """The row with the highest version per key; equal versions fall to the other columns."""
    return keep_first(df, key, [
        *descending([version, *_remaining(df, [*key, version])]), *_maps(df, "DESC")])


def one_row_per_order(facts: DataFrame) -> DataFrame:
    """Facts with each order once, at its earliest event."""
    return drop_duplicates(facts, ["order_id"], order=["event_time", "user_id", "session_id"])


def apply_changes(current: DataFrame, changes: DataFrame, key: Sequence[str],
                  version: str, position: str = "_position",
                  deleted: str = "_deleted") -> DataFrame:
    """Upsert a change log into a table.

    ``changes`` has the table's columns plus a log position and a delete flag. The highest
    version wins, then the later log position, then the delete, because a delete repeats the
    version of the row it removes.
    """
    base = (current.withColumn(position, F.lit(-1).cast("bigint"))
            .withColumn(deleted, F.lit(False)))
    log = changes.select(*base.columns)
    rest = _remaining(base, [*key, version, position, deleted])
    latest = keep_first(base.unionByName(log), key,
                        descending([version, position, deleted, *rest]))
    return latest.filter(~F.col(deleted)).drop(position, deleted)
