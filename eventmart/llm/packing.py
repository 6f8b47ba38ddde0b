"""Packing documents into sequences of a fixed number of tokens by exact complements.

A document becomes token ids and an end id. One that is longer than a sequence is cut into full
sequences, its first piece taking what is left over. Which pieces share a sequence depends only on
their lengths, so the plan is made from the number of pieces of each length, at most as many
numbers as a sequence has tokens:

1. Exact complements. Lengths are taken from the longest down. For each, the gap it leaves is
   looked up among single lengths, sums of two and sums of three; combinations that fill it
   exactly are consumed as often as their lengths are available.
2. Best fit. Complements that leave a token free, then two and so on, are consumed alike; what
   remains goes, longest first, into the open sequences with the smallest gap
   that takes it; sequences of one content are handled together by their number.

Tasks do the first step for full blocks of pieces as they tokenize, so most pieces of a large table
find their sequence without leaving their task. Only the rest is planned over all tasks: these pieces get their place
by their rank among pieces of their length, and ranks come from counts per task and length, so no
task sees all pieces of a length.
"""

from __future__ import annotations

import base64
import json
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import arrow_schema, chunks, columns, documents, record_batch, staged

CAPACITY = 1024
#: Complements over all tasks may leave up to this part of a sequence free before best fit.
SLACK_SHARE = 32
#: A task looks for complements among so many pieces at a time.
BLOCK = 4096
END_ID = 2


class Encoder:
    """Ids of the byte-level vocabulary that ``path`` (a tokenizer's .json) names.

    ``path`` and the ranks of the same vocabulary beside it (.tiktoken) give the same ids; the
    ranks are about three times as fast. A text with a special token's string, or one that the
    fast way refuses, goes through the tokenizer itself.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        self.path, self.exact = path, None
        with open(path, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks,
                                      special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text)
            except BaseException as refused:  # a panic of the library is no Exception
                if isinstance(refused, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.path)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


PIECES = ("doc_id long, piece int, start long, length long, ids binary, sequence_id long, "
          "offset long, task int, local_rank long")
PIECE_SCHEMA = arrow_schema(PIECES)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` ids; only the first may be shorter than the rest."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)] if n else []


@dataclass
class Plan:
    """Contents (lengths of a sequence's pieces, in order) and how many sequences have each."""

    capacity: int
    contents: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    def sequences(self) -> int:
        return sum(n for _, n in self.contents)


def times(parts: tuple[int, ...], left: dict[int, int]) -> int:
    """How often the parts are all available."""
    return min(left.get(p, 0) // parts.count(p) for p in set(parts))


def triples(gap: int, lengths: list[int], known: set[int]) -> Iterator[tuple[int, int, int]]:
    """Sums of three that fill the gap, the most even first: short pieces fit anywhere later on."""
    for i in range(bisect_left(lengths, -(-gap // 3)), len(lengths)):
        a = lengths[i]
        if a >= gap:
            return
        rest = gap - a
        for b in lengths[bisect_left(lengths, -(-rest // 2)):i + 1]:
            if b >= rest:
                break
            if rest - b in known:
                yield a, b, rest - b


def exact_complements(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Consumes lengths from ``left`` in combinations that fill a sequence exactly."""
    found: list[tuple[tuple[int, ...], int]] = []

    def consume(parts: tuple[int, ...]) -> None:
        n = times(parts, left)
        if n:
            found.append((parts, n))
            for p in parts:
                left[p] -= n

    for longest in sorted((x for x, n in left.items() if n and x <= capacity), reverse=True):
        gap = capacity - longest
        if left[longest] and not gap:
            consume((longest,))
        if left[longest] and gap:
            consume((longest, gap))
        lengths = sorted(x for x, n in left.items() if n and x <= longest)
        known = set(lengths)
        for a in lengths[bisect_left(lengths, -(-gap // 2)):]:
            if not left[longest] or a >= gap:
                break
            if gap - a in known:
                consume((longest, a, gap - a))
        if left[longest]:
            lengths = [x for x in lengths if left[x]]
            for parts in triples(gap, lengths, set(lengths)):
                if not left[longest]:
                    break
                consume((longest, *parts))
    return found


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for lengths with counts; open sequences of equal gap are groups."""
    gaps: list[int] = []
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(content: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(content)
        if gap not in open_at:
            open_at[gap] = []
            gaps.insert(bisect_left(gaps, gap), gap)
        open_at[gap].append((content, n))

    for length in sorted((x for x, n in left.items() if n), reverse=True):
        n = left[length]
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fits = capacity // length
                if n // fits:
                    put((length,) * fits, n // fits)
                if n % fits:
                    put((length,) * (n % fits), 1)
                break
            group = open_at[gaps[at]]
            content, have = group.pop()
            if not group:
                del open_at[gaps.pop(at)]
            used = min(n, have)
            if have > used:
                put(content, have - used)
            put((*content, length), used)
            n -= used
    return [x for group in open_at.values() for x in group]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Exact complements, then complements that leave 1, 2, ... tokens free, then best fit; or best
    fit alone where that needs fewer sequences, as with few pieces."""
    left, done = {x: n for x, n in counts.items() if n}, []
    alone = Plan(capacity, best_fit(left, capacity))
    for free in range(capacity // SLACK_SHARE + 1):
        done += exact_complements(left, capacity - free)
    return min(Plan(capacity, done + best_fit(left, capacity)), alone, key=Plan.sequences)


@dataclass
class Places:
    """For each length, where each stretch of ranks goes: sorted by length and first rank."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, made: Plan) -> Places:
        rows, used, sequence = [], defaultdict(int), 0
        for content, n in made.contents:
            at = 0
            for length in content:
                rows.append((length, used[length], sequence, at))
                used[length] += n
                at += length
            sequence += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(*table.T)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks."""
        low = np.searchsorted(self.length, lengths, "left")
        high = np.searchsorted(self.length, lengths, "right")
        at = np.array([a + np.searchsorted(self.first[a:b], r, "right") - 1
                       for a, b, r in zip(low, high, ranks, strict=True)], np.int64)
        return self.sequence[at] + ranks - self.first[at], self.offset[at]


def settled(block: list[tuple], capacity: int, task: int, number: int,
            ranks: dict[int, int]) -> tuple[list[tuple], int]:
    """The block's pieces as rows of PIECES, and the next free sequence number of the task. Pieces
    in exact sequences have a sequence and an offset, the rest a rank among the task's rest."""
    stacks: dict[int, list[tuple]] = defaultdict(list)
    for row in block:
        stacks[row[3]].append(row)
    rows = []
    for content, n in exact_complements({x: len(s) for x, s in stacks.items()}, capacity):
        for _ in range(n):
            at = 0
            for length in content:
                rows.append((*stacks[length].pop(), task << 40 | number, at, task, None))
                at += length
            number += 1
    for length, stack in stacks.items():
        for row in stack:
            rows.append((*row, None, None, task, ranks[length]))
            ranks[length] += 1
    return rows, number


def tokenized(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY,
              end_id: int = END_ID) -> DataFrame:
    """The pieces with their ids (little-endian, 32 bits each), in sequences where their task found
    exact complements."""
    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task = Encoder(path, pattern), TaskContext.get().partitionId()
        ranks: dict[int, int] = defaultdict(int)
        block, number = [], 0
        for batch in chunks(batches):
            for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True):
                ids = np.append(encode(text or ""), end_id).astype("<u4")
                block += [(doc_id, k, start, length, ids[start:start + length].tobytes())
                          for k, (start, length) in enumerate(cut(len(ids), capacity))]
            if len(block) >= BLOCK:
                rows, number = settled(block, capacity, task, number, ranks)
                yield record_batch(rows, PIECE_SCHEMA)
                block = []
        rows = []
        for row in block:  # too few for complements of their own
            rows.append((*row, None, None, task, ranks[row[3]]))
            ranks[row[3]] += 1
        yield record_batch(rows, PIECE_SCHEMA)

    return documents(docs).mapInArrow(made, PIECES)


PACKED = ("doc_id long, piece int, start long, length long, ids binary, sequence_id long, "
          "offset long")


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: its place in its document, its ids, its sequence and offset there.

    Null and empty texts are one piece, the end id alone. Repeated rows and null ids are pieces of
    their own like any other. Only doc_id and text are read. No row in, no row out. The pieces
    are written once to the shared folder; what reaches the driver are counts per task and
    length, then totals per length.
    """
    pieces = staged(tokenized(docs, path, pattern, capacity, end_id), "pieces",
                    compression="zstd")
    packed = [x.split()[0] for x in PACKED.split(", ")]
    rest = pieces.where("sequence_id IS NULL")
    counts = rest.groupBy("length", "task").agg(F.count("*").alias("n"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places.of(plan(totals, capacity))
    before = counts.select("length", "task", (F.expr(
        "sum(n) OVER (PARTITION BY length ORDER BY task)") - F.col("n")).alias("before"))
    ranked = rest.join(before, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids",
        (F.col("before") + F.col("local_rank")).alias("rank"))
    out = arrow_schema(PACKED)

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            # Task numbers are not negative, so these do not meet those that tasks gave.
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(-1 - sequence), pa.array(offset)], schema=out)

    return pieces.where("sequence_id IS NOT NULL").select(*packed).unionAll(
        ranked.mapInArrow(placed, PACKED))
