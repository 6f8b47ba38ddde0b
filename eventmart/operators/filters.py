"""Filters by a set of keys, ahead of a join on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.skew import BROADCAST_BYTES, payload_bytes


def key_filter(keys: DataFrame, on: Sequence[str],
               max_bytes: int = BROADCAST_BYTES) -> Callable[[DataFrame], DataFrame]:
    """A filter to rows whose key is in ``keys``, or one that keeps all if the keys are many.

    It goes ahead of a join on the same key, so either way the join's result is the same;
    with few keys it spares the shuffle of a whole table. ``keys`` is read to be measured, so
    pass a stored, cached or small frame.
    """
    distinct = keys.select(*on).distinct()
    if payload_bytes(distinct) > max_bytes:
        return lambda df: df
    return lambda df: df.join(F.broadcast(distinct), list(on), "left_semi")


#: Keys that a scan is asked for one by one.
POINT_KEYS = 1000


def point_filter(keys: DataFrame, on: Sequence[str],
                 most: int = POINT_KEYS) -> Callable[[DataFrame], DataFrame]:
    """Like :func:`key_filter`, and with at most ``most`` keys their values are named in the scan,
    so that row groups without them are skipped by their statistics or Bloom filters. Without any
    key nothing is scanned."""
    few = keys.select(*on).distinct().limit(most + 1).collect()
    if len(few) > most:
        return key_filter(keys, on)
    named = reduce(Column.__and__, [
        F.col(name).isin([row[name] for row in few if row[name] is not None]) for name in on])
    listed = F.broadcast(keys.sparkSession.createDataFrame(few, keys.select(*on).schema))
    return lambda df: df.where(named).join(listed, list(on), "left_semi")
