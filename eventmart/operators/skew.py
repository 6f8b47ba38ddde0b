"""Joins whose sides may be too big to broadcast and whose keys may be hot.

Hot keys are found exactly. Rows are counted by hash bucket first, combined on the map side, so
at most ``BUCKETS`` rows leave that count; keys are counted only in buckets that could hold a hot
one. A hot key gets a salt per so many of its rows: rows of the skewed side spread over them and the
other side's rows of that key are repeated. Everything else joins as usual, and the join's result
is the plain join's result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16384
ROWS_PER_SALT = 500_000
# A key is hot only above its part of this many, so that fewer keys than this are ever hot and
# their list is small enough to broadcast.
MOST_HOT_KEYS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS,
             rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Keys that need more than one salt: the keys and ``_salts``, fewer than MOST_HOT_KEYS rows."""
    keyed = df.select(*keys).withColumn("_bucket", _bucket(keys, buckets))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per bucket is left here, so one window group over all of them is bounded.
    total = F.sum("_rows").over(Window.partitionBy(F.lit(0)))
    full = counts.withColumn("_most", F.greatest(
        F.lit(float(rows_per_salt)), total / F.lit(MOST_HOT_KEYS))).filter("_rows > _most")
    return (keyed.join(F.broadcast(full.select("_bucket", "_most")), "_bucket")
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max("_most").alias("_most"))
            .filter("_rows > _most")
            .select(*keys, F.ceil(F.col("_rows") / F.col("_most")).cast("int").alias("_salts")))


def salted_join(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str,
                spread: Sequence[str], count_on: DataFrame | None = None,
                buckets: int = BUCKETS, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Join ``many`` to ``one`` on ``keys`` with hot keys of ``many`` spread over tasks.

    ``how`` is inner, left, left_semi or left_anti. ``spread`` names columns that differ
    within a hot key; the salt is their hash, so a task that runs again gives the same rows.
    ``count_on`` may be a cheaper frame with the same keys, such as the raw table under a
    de-duplicated one: it only steers the salts, never the result.
    """
    keys = list(keys)
    source = many if count_on is None else count_on
    hot = F.broadcast(hot_keys(source, keys, buckets, rows_per_salt))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    left = (many.join(hot, keys, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_salts"))
    right = (one.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def payload_bytes(df: DataFrame) -> int:
    """Bytes the rows take in memory, measured by one aggregate over the frame."""
    width = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(f.name)))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]


def lookup_join(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str,
                spread: Sequence[str], max_bytes: int = BROADCAST_BYTES,
                broadcast: bool | None = None) -> DataFrame:
    """Join to a dimension: broadcast if its measured size allows it, salted otherwise.

    ``broadcast`` passes on the outcome of an earlier measurement.
    """
    if broadcast is None:
        broadcast = payload_bytes(dimension) <= max_bytes
    if broadcast:
        return facts.join(F.broadcast(dimension), list(keys), how)
    return salted_join(facts, dimension, keys, how, spread)
