"""Filters of fixed size over sets of ids that may be large.

A filter passes every id of its set and a few others, so it only spares work: what it passes still
meets the set in a join. Its size does not depend on the data, so it may go to every task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import numbered, staged

#: 64-bit words: 512 KiB, which keeps false passes under 3 % up to 120,000 ids.
WORDS = 1 << 16


def slot(h: Column, words: int = WORDS) -> Column:
    return F.shiftright(h, 6).bitwiseAND(words - 1).cast("int")


def bit(h: Column) -> Column:
    return h.bitwiseAND(63).cast("int")


def words_of(ids: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """The filter of a column of hashes as a table (slot, bits), at most ``words`` rows."""
    h = F.col(column)
    return ids.select(slot(h, words).alias("slot"), bit(h).alias("bit")).distinct().groupBy(
        "slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def bits_of(ids: DataFrame, column: str, words: int = WORDS) -> np.ndarray:
    """The filter of a column of hashes; at most ``words`` numbers reach the driver."""
    rows = words_of(ids, column, words).toPandas()
    found = np.zeros(words, np.int64)
    found[rows["slot"]] = rows["bits"]
    return found


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash passes, in a task."""
    word = bits[(h >> 6) & (len(bits) - 1)]
    return (word >> (h & 63)) & 1 == 1


def without(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows whose id is not among ``ids`` (a column of the same name, without repeats); null ids stay.

    Rows that the filter does not pass are surely not among them and stay where they are; only the
    others meet the ids in a join. The filter goes to the tasks as a broadcast table, not as a
    constant: Spark writes a plan's constants out in the text of every event about it, which took
    the driver hundreds of MB. Columns may have any names.
    """
    ids = staged(ids.select(column), "ids")
    words = F.broadcast(staged(words_of(ids.select(F.xxhash64(column).alias("h")), "h"), "filter"))
    plain, names = numbered(df)
    key = f"c{names.index(column)}"
    h = F.xxhash64(key)
    maybe = F.col(key).isNotNull() & (slot(h) == F.col("slot")) & (F.getbit("bits", bit(h)) == 1)
    return plain.join(words, maybe, "left_anti").unionAll(plain.join(words, maybe, "left_semi").join(
        ids.withColumnRenamed(column, key), key, "left_anti").select(*plain.columns)).toDF(*names)
