"""Fill-in-the-middle: a document is cut in three and its middle moved to the end, between sentinels.

Cuts are drawn in code points, texts are bytes of UTF-8. Only characters of several bytes make the
two differ, so an index holds those alone: the byte at which each starts, its place in code points and the
bytes in excess of one up to it. A cut is converted by a binary search in it and one addition; a text
without such characters has an empty index, and the cut is its own place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import arrow_schema, chunks, columns, documents

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred documents, those that are transformed, and of these, those with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Exceptions:
    """The characters of several bytes in a text: byte offsets, places in code points, and excess
    bytes of all up to each (one entry more, 0 first)."""

    n_bytes: int
    offsets: np.ndarray
    places: np.ndarray
    excess: np.ndarray

    @staticmethod
    def of(raw: bytes) -> Exceptions:
        if raw.isascii():
            return Exceptions(len(raw), _NONE, _NONE, _ZERO)
        units = np.frombuffer(raw, np.uint8)
        offsets = np.flatnonzero(units >= 0xC0)
        lead = units[offsets]
        excess = np.concatenate([_ZERO, np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)])
        return Exceptions(len(raw), offsets, offsets - excess[:-1], excess)

    @property
    def n(self) -> int:
        """Code points."""
        return self.n_bytes - int(self.excess[-1])

    def bytes_at(self, places: np.ndarray) -> np.ndarray:
        """The byte offsets of places in code points."""
        return places + self.excess[np.searchsorted(self.places, places, "left")]

    def places_at(self, offsets: np.ndarray) -> np.ndarray:
        """The places in code points of byte offsets that do not lie inside a character."""
        return offsets - self.excess[np.searchsorted(self.offsets, offsets, "left")]


_NONE, _ZERO = np.zeros(0, np.int64), np.zeros(1, np.int64)


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four numbers of 32 bits from the id; a null id counts as empty text."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    head = hashlib.sha256(key.encode()).digest()[:16]
    return tuple(int.from_bytes(head[i:i + 4], "big") for i in range(0, 16, 4))


def rearranged(doc_id: int | None, raw: bytes, seed: int, transformed: int,
               suffix_first: int) -> tuple[int, str, int | None, int | None, bytes]:
    """The columns of SCHEMA after doc_id, the output as bytes."""
    index = Exceptions.of(raw)
    n = index.n
    first, second, form, order = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not raw or any(m in raw for m in marks) or form % 100 >= transformed:
        return n, PLAIN, None, None, raw
    low, high = sorted((first % (n + 1), second % (n + 1)))
    a, b = index.bytes_at(np.array([low, high])).tolist()
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    # What is told about the cuts comes from the bytes that were cut.
    n_prefix, end = index.places_at(np.array([len(prefix), len(prefix) + len(middle)])).tolist()
    p, s, m = marks
    if order % 100 < suffix_first:
        return n, SPM, n_prefix, end - n_prefix, b"".join([s, suffix, p, prefix, m, middle])
    return n, PSM, n_prefix, end - n_prefix, b"".join([p, prefix, s, suffix, m, middle])


def transform(docs: DataFrame, seed: int = SEED, transformed: int = TRANSFORMED,
              suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: its length in code points, form, cuts and rearranged text.

    Null and empty texts, texts that hold a sentinel and ``100 - transformed`` of a hundred others are plain: the
    text as it is (null: empty), with null cuts. The same id and seed always give the same draws,
    so repeated rows get equal results. Columns other than doc_id and text are not read. No row
    in, no row out.
    """
    out = arrow_schema(SCHEMA)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, = columns(batch, "doc_id")
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            rows = [(i, *rearranged(i, t or b"", seed, transformed, suffix_first))
                    for i, t in zip(ids, texts, strict=True)]
            *rest, outputs = zip(*rows, strict=True) if rows else [()] * len(out)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, f.type) for c, f in zip(rest, out, strict=False)),
                 pa.array(outputs, pa.binary()).cast(pa.string())], schema=out)

    return documents(docs).mapInArrow(cut, SCHEMA)


def restore(found: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``restored``, the text rebuilt from form and output alone.

    No part holds a sentinel, and none begins within another, so the output falls apart at them.
    """
    parts = F.split("output", f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return found.withColumn("restored", F.when(F.col("form") == PLAIN, F.col("output")).when(
        F.col("form") == SPM, F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    ).otherwise(F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))))


def digests(found: DataFrame) -> DataFrame:
    """Of ``transform``: digests of the output and of the restored text in their places."""
    return restore(found).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        *[F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256") for name in ("output", "restored")])
