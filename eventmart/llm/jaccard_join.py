"""Documents whose sets of word shingles are similar: an exact join on a partition of the universe.

Sets of sizes a and b with a Jaccard similarity of 3/4 differ in at most (a + b) / 7 shingles. Hash
the universe of shingles into segments; if a set has more non-empty segments than it may differ
from another, some non-empty segment is the same in both, and the two meet there. Here:

- Sizes fall into bands, each with segments of its own, half as many again as its smallest set has
  shingles. A set that can be similar to one of the band below also takes part there.
- Segments have an order, and a set uses only as many as it needs, from the front: of two sets, the
  one that stops first has used enough, and the other has used those too. Empty segments do not
  count.
- Frequent shingles are taken out of the segments; each is a segment of its own at the end of the
  order, the more frequent the later. So common passages become meeting points only for sets that
  have little else. They are counted over all documents, but a task reports only those that two
  of its different sets hold; one that it leaves out costs comparisons and loses nothing.
- By cost, a band may use one-deletion neighbourhoods: a segment with two shingles or more then
  also stands for itself without any one of them, survives one difference and counts twice. It
  needs more entries but fewer frequent shingles.
- A set with too few segments for its size (possible by chance) uses all of them, and meets others
  of that kind by single shingles.

Sets that share segments are candidates. Of the sets in a segment, each is compared with one, the
most typical; what that links is one component. Only pairs in different components that share
enough segments are compared further. Every comparison counts the shingles that both have.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import arrow_schema, chunks, columns, documents, record_batch, staged
from eventmart.llm.components import components
from eventmart.llm.filters import bits_of, passes

SHINGLE = 5
#: Sets under this size have a segment per shingle; from it on, bands double.
LEAST_BAND = 16
#: The counted shingles that every task knows: the most frequent, with a count of at least so many.
FREQUENT, LEAST_COUNT = 1 << 17, 8
#: A task counts so many shingles at a time and reports those that it sees in so many documents.
COUNTED_AT_ONCE, REPORTED = 2_000_000, 2
#: Entries that a task gathers before it sends them, and that a task is meant to receive.
SENT_AT_ONCE, RECEIVED = 1_000_000, 500_000
#: A comparison is taken to cost as much as so many entries.
COMPARISON_COST = 4.0
#: Comparisons with one set that a task makes.
GROUP_ROWS = 256
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: The schemes of sets with too few segments, and of single shingles of sets that use frequent ones.
LEFT_OVER, SINGLE = 99, 98


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * MULTIPLIER
    return h ^ (h >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of five words, A-Z in lower case; of all its words
    if there are fewer; none without words."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = total * MULTIPLIER + hashes[i:len(words) - size + 1 + i]
    return np.unique(mixed(total))


def set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def most_different(n: int) -> int:
    """Shingles in which a set of ``n`` may differ from a similar one, whatever that one's size."""
    return (n + 4 * n // 3) // 7


def band_of(n: int) -> int:
    return 0 if n < LEAST_BAND else int(n // LEAST_BAND).bit_length()


def segments_in(band: int) -> int:
    return 3 * (LEAST_BAND << (band - 1)) // 2


COUNTS = "kind int, id long, n long, key binary, frequent long"


def counted_sets(docs: DataFrame) -> DataFrame:
    """Kind 0, a row per document: id, size and key of its set. Kind 1: a shingle and in how many of a
    task's different sets it is, if more than one."""
    out = arrow_schema(COUNTS)

    def reported(sets: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(sets), return_counts=True)
        often = n >= REPORTED
        values, n = values[often], n[often]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(n), np.int32)), pa.array(values.view(np.int64)),
             pa.array(n.astype(np.int64)), pa.nulls(len(n), pa.binary()),
             pa.nulls(len(n), pa.int64())], schema=out)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        sets, size = [], 0
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True):
                found = shingles(text or "")
                key = set_key(found)
                rows.append((0, doc_id, len(found), key, None))
                if len(found) and key not in seen:
                    seen.add(key)
                    sets.append(found)
                    size += len(found)
            yield record_batch(rows, out)
            if size > COUNTED_AT_ONCE:
                yield reported(sets)
                sets, size = [], 0
                seen.clear()
        if sets:
            yield reported(sets)

    return documents(docs).mapInArrow(counted, COUNTS)


@dataclass
class Scheme:
    """What every task knows: the frequent shingles with their ranks (later is more frequent), and the
    bands that use one-deletion neighbourhoods."""

    frequent: np.ndarray
    rank: np.ndarray
    deleting: frozenset[int]

    def ranks(self, found: np.ndarray) -> np.ndarray:
        """The rank of each shingle, 0 for those that are not frequent."""
        if not len(self.frequent):
            return np.zeros(len(found), np.int64)
        at = np.minimum(np.searchsorted(self.frequent, found), len(self.frequent) - 1)
        return np.where(self.frequent[at] == found, self.rank[at], 0)


def seed_of(band: int) -> np.uint64:
    return np.uint64((band + 1) * int(MULTIPLIER) & 0xFFFFFFFFFFFFFFFF)


def entries(found: np.ndarray, scheme: Scheme, band: int) -> tuple[np.ndarray, bool, bool]:
    """The entries of a set in a band, whether its segments were enough, and whether the rare ones were.

    Each is a hash of the band, the segment and the segment's shingles, odd for frequent shingles
    and even for others.
    """
    needed = most_different(len(found)) + 1
    rank = scheme.ranks(found)
    rare, common = found[rank == 0], found[rank > 0]
    seed = seed_of(band)
    made: list[np.ndarray] = []
    weight = 0
    if band in (0, LEFT_OVER):
        made.append(np.sort(mixed(rare + seed))[:needed])
        weight = len(made[0])
    elif len(rare):
        segment = (mixed(rare) % np.uint64(segments_in(band))).astype(np.int64)
        by = np.argsort(segment, kind="stable")
        segment, values = segment[by], mixed(rare[by])
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        n = np.diff(np.r_[first, len(by)])
        weights = np.where(n > 1, 2, 1) if band in scheme.deleting else np.ones(len(n), np.int64)
        used = min(len(n), int(np.searchsorted(np.cumsum(weights), needed)) + 1)
        weight = int(weights[:used].sum())
        place = mixed(segment[first[:used]].astype(np.uint64) + seed)
        made.append(mixed(np.add.reduceat(values, first)[:used] + place))
        if band in scheme.deleting:
            for i in np.flatnonzero(n[:used] > 1):
                part = values[first[i]:first[i] + n[i]]
                made.append(mixed(part.sum(dtype=np.uint64) - part + place[i]))
    rare_enough = weight >= needed
    made = [m & ~np.uint64(1) for m in made]
    if not rare_enough:
        order = np.lexsort((common, rank[rank > 0]))[:needed - weight]
        weight += len(order)
        if 4 * len(common) >= 3 * len(found):
            made.append(mixed(common[order] + mixed(np.array([seed]))) | np.uint64(1))
    return (np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64),
            weight >= needed, rare_enough)


def all_entries(found: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, int | None]:
    """The entries of a set in its band, in the band below if a similar set may be there, and among
    those with too few segments if it is one of them.

    A set that needs frequent shingles also stands under each of its rare ones. Two such sets that
    meet under none have no rare shingle in common, so their frequent ones are all they can share:
    the second result is how many those are, or None for other sets. With less than three
    quarters frequent, nothing is similar by frequent shingles alone, and they are left out.
    """
    n = len(found)
    band = band_of(n)
    made, enough, rare_enough = [], True, True
    for b in [band, band - 1] if band and band_of(-(-3 * n // 4)) < band else [band]:
        own, fits, fits_rare = entries(found, scheme, b)
        made.append(own)
        enough, rare_enough = enough and fits, rare_enough and fits_rare
    if not enough:
        own, _, fits_rare = entries(found, scheme, LEFT_OVER)
        made.append(own)
        rare_enough = rare_enough and fits_rare
    if rare_enough:
        return np.concatenate(made), None
    rare = found[scheme.ranks(found) == 0]
    made.append(mixed(rare + seed_of(SINGLE)) & ~np.uint64(1))
    return np.concatenate(made), n - len(rare)


def packed(values: np.ndarray, ids: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """Sorted entries and the documents they are of, byte by byte of equal weight, compressed."""
    order = np.argsort(values)
    both = np.stack([values[order].view(np.int64), ids[order]])
    steps = both[0].view(np.uint64)
    steps[1:] = np.diff(steps)
    return press.compress(np.ascontiguousarray(
        both.view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1)).tobytes())


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(2, 8, -1)
    both = np.ascontiguousarray(raw.transpose(0, 2, 1)).view(np.int64)[:, :, 0]
    return np.cumsum(both[0].view(np.uint64)), both[1]


MET = "entry long, doc_id long, told boolean"


def meeting_points(docs: DataFrame, scheme: Scheme, total: int) -> DataFrame:
    """entry and doc_id of every entry that more than one document has; with ``told`` set, doc_id and
    the number of its frequent shingles instead, for documents that use them.

    Tasks send their entries packed, split by value; of equal sets a task sends one.
    """
    tasks = max(1, -(-total // (2 * RECEIVED)))
    parts = 4 * tasks  # several to a task, so that hashing deals them evenly
    sent = "part int, data binary"
    sent_schema, out = arrow_schema(sent), arrow_schema(MET)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        seen: set[bytes] = set()
        values, ids, size = [], [], 0
        frequent: dict[int, int] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            value, owner = np.concatenate(values), np.concatenate(ids)
            part = (value % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[by], np.arange(parts + 1))
            for p in range(parts):
                at = by[bounds[p]:bounds[p + 1]]
                if len(at):
                    yield record_batch([(p, packed(value[at], owner[at], press))], sent_schema)
            if frequent:
                data = packed(np.array(list(frequent.values()), np.uint64),
                              np.array(list(frequent), np.int64), press)
                # From here on parts tell these numbers from entries, and spread them over all tasks.
                yield record_batch([(parts + next(iter(frequent)) % parts, data)], sent_schema)
                frequent.clear()

        for batch in chunks(batches):
            for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True):
                found = shingles(text or "")
                if not len(found) or doc_id is None or (key := set_key(found)) in seen:
                    continue
                seen.add(key)
                made, common = all_entries(found, scheme)
                if common is not None:
                    frequent[doc_id] = max(common, frequent.get(doc_id, 0))
                values.append(made)
                ids.append(np.full(len(made), doc_id, np.int64))
                size += len(made)
            if size > SENT_AT_ONCE:
                yield from flushed()
                values, ids, size = [], [], 0
        if size:
            yield from flushed()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for batch in batches:
            for part, data in zip(*columns(batch, "part", "data"), strict=True):
                pair = unpacked(data)
                if part < parts:
                    got.append(pair)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pair[0].view(np.int64)), pa.array(pair[1]),
                         pa.array(np.ones(len(pair[1]), bool))], schema=out)
        if not got:
            return
        value, owner = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        del got
        order = np.argsort(value)
        value, owner = value[order], owner[order]
        same = value[1:] == value[:-1]
        shared = np.r_[same, False] | np.r_[False, same]
        value, owner = value[shared].view(np.int64), owner[shared]
        for i in range(0, len(value), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[i:i + 100_000]), pa.array(owner[i:i + 100_000]),
                 pa.array(np.zeros(len(value[i:i + 100_000]), bool))], schema=out)

    return documents(docs).mapInArrow(send, sent).repartition(tasks, "part").mapInArrow(meet, MET)


def sizes_allow(a: str, b: str) -> Column:
    """Whether two sets' sizes allow a similarity of 3/4; an unknown size allows it."""
    return F.coalesce((3 * F.col(a) <= 4 * F.col(b)) & (3 * F.col(b) <= 4 * F.col(a)), F.lit(True))


def may_meet() -> Column:
    """Whether the sets (n, common) and (other_n, other_common) may be similar by this entry.

    At a frequent shingle, these have to be enough, as sets with a rare shingle in common also meet
    there. If both were compared with the same set (with), they share at most as many of its frequent
    shingles as the one that has fewer of them (near), and likewise of other frequent shingles. An
    unknown size allows everything.
    """
    most = F.when(F.col("with") == F.col("other_with"), F.least("near", "other_near") + F.least(
        F.col("common") - F.col("near"), F.col("other_common") - F.col("other_near")))
    enough = 7 * F.coalesce(most, F.least("common", "other_common")) >= 3 * (
        F.col("n") + F.col("other_n"))
    return sizes_allow("n", "other_n") & (
        (F.col("entry").bitwiseAND(F.lit(1)) == 0) | F.coalesce(enough, F.lit(True)))


def shared_least(plain: Column) -> Column:
    """Entries that two similar sets share at least.

    The one that stops first has used at least one segment more than the smaller set may differ
    from any other, and each difference spoils one. It is one with deletions, with an unknown size,
    and for two sets that use frequent shingles, as may_meet leaves some of their entries out.
    """
    a, b = "n", "other_n"
    small = F.least(a, b)
    used = F.floor((small + F.floor(4 * small / 3)) / 7) + 1
    both = F.when(plain & F.col(a).isNotNull() & F.col(b).isNotNull()
                  & (F.col("common").isNull() | F.col("other_common").isNull()),
                  used - F.floor((F.col(a) + F.col(b)) / 7))
    return F.greatest(F.lit(1), F.coalesce(both, F.lit(1)))


COMPARED = "owner long, other long, both long, n long, other_n long, frequent long"


def similar_only(compared: DataFrame) -> DataFrame:
    """The links (a, b) among compared pairs."""
    return compared.where("100 * both >= 75 * (n + other_n - both)").select(
        F.col("owner").alias("a"), F.col("other").alias("b"))


def compare(docs: DataFrame, pairs: DataFrame, scheme: Scheme) -> DataFrame:
    """For the pairs (owner, other) the shingles that both have, their sizes, and how many of the shared
    ones are frequent. Ids that stand for several texts have a row for each two texts.

    Only documents in pairs are taken apart: a filter of fixed size passes them and few others. All
    partners of an owner meet its set in one place, in parts of GROUP_ROWS where they are many.
    """
    pairs = staged(pairs.select("owner", "other"), "pairs")
    parted = pairs.groupBy("owner").agg(
        F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("parts"))
    asked = staged(pairs.join(parted, "owner").select(
        F.col("other").alias("doc_id"), "owner",
        F.pmod(F.xxhash64("other"), F.col("parts")).cast("int").alias("part"),
        F.lit(1).alias("role")).unionAll(parted.select(
            F.col("owner").alias("doc_id"), "owner",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.lit(0).alias("role"))), "asked")
    bits = bits_of(asked.select(F.xxhash64("doc_id").alias("h")), "h")
    set_schema = arrow_schema("doc_id long, found binary")

    def taken(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            h = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(passes(bits, h)))
            yield record_batch([(d, shingles(t).tobytes()) for d, t in zip(
                *columns(batch, "doc_id", "text"), strict=True)], set_schema)

    sets = documents(docs).where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(taken, "doc_id long, found binary")
    met = asked.join(sets, "doc_id").repartition("owner", "part").sortWithinPartitions(
        "owner", "part", "role")
    out = arrow_schema(COMPARED)

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in chunks(batches, 1024):
            rows = []
            for doc_id, owner, part, role, raw in zip(
                    *columns(batch, "doc_id", "owner", "part", "role", "found"), strict=True):
                found = np.frombuffer(raw, np.uint64)
                if (owner, part) != at:
                    at, held = (owner, part), []
                if role == 0:
                    held.append(found)
                    continue
                for own in held:
                    if len(own) and len(found):
                        both = found[own[np.minimum(np.searchsorted(own, found), len(own) - 1)] == found]
                        rows.append((owner, doc_id, len(both), len(own), len(found),
                                     int((scheme.ranks(both) > 0).sum())))
            yield record_batch(rows, out)

    return met.mapInArrow(compared, COMPARED)


def make_scheme(counts: DataFrame, sizes: DataFrame) -> Scheme:
    """The frequent shingles, at most FREQUENT of them, and for each band the cheaper way.

    Per set of a band, plain segments cost their entries and, where rare segments do not suffice,
    the comparisons that frequent shingles bring; deletions cost more entries and need fewer of
    those. The share of frequent shingles is that of the whole corpus. The list and the choice
    decide what is compared, never what is found.
    """
    rows = counts.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where(
        F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "id").limit(FREQUENT).toPandas()
    values = rows["id"].to_numpy(np.int64).view(np.uint64)
    n = rows["n"].to_numpy(np.int64)
    order = np.argsort(values)
    rank = np.log2(np.maximum(n, 1)).astype(np.int64) + 1
    bands = sizes.where("n >= 1").groupBy(
        F.when(F.col("n") < LEAST_BAND, 0).otherwise(
            F.floor(F.log2(F.floor(F.col("n") / LEAST_BAND))) + 1).cast("int").alias("band")).agg(
        F.avg("n").alias("n"), F.sum("n").alias("total")).collect()
    total = sum(b.total for b in bands)
    share = min(1.0, n.sum() / total) if total else 0.0
    weight = float((n * n).sum() / n.sum()) if len(n) else 0.0  # sets at a frequent shingle
    deleting = set()
    for b in bands:
        if b.band:
            m, needed = segments_in(b.band), most_different(int(b.n)) + 1
            load = (1 - share) * b.n / m
            some = m * -np.expm1(-load)
            several = some - m * load * np.exp(-load)
            plain = needed + COMPARISON_COST * weight * max(0.0, needed - some)
            used = min(1.0, needed / max(some + several, 1e-9))
            deleted = used * (some + m * load) + COMPARISON_COST * weight * max(
                0.0, needed - some - several)
            if deleted < plain:
                deleting.add(int(b.band))
    return Scheme(values[order], rank[order], frozenset(deleting))


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per document: n_shingles and component_id, the smallest id that links reach.

    Documents link if 100 times the shingles that both have is at least 75 times those that either
    has. Null, empty and wordless texts have no shingles and link with nothing. Rows that share an
    id are one document: each row has its own n_shingles, and what any of them links is linked. A
    null id links with nothing and has no component. Only doc_id and text are read.
    """
    counts = staged(counted_sets(docs), "counts")
    rows = counts.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "key")
    # Written by itself, so that the join shuffles both sides and may split a set with many copies.
    first = staged(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"),
        "copies")
    named = staged(rows.join(first, "key", "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("first")),
        "named")
    scheme = make_scheme(counts, rows)
    total = named.agg(F.sum("n")).first()[0] or 0
    found = staged(meeting_points(docs, scheme, total), "meetings")
    # Ids of one set become its first; a row that shares its id with another text keeps all its firsts.
    info = named.where("doc_id IS NOT NULL AND n > 0").select("doc_id", "first", "n").distinct()
    twice = info.groupBy("doc_id").agg(F.count("*").alias("texts")).where("texts > 1")
    info = info.join(twice, "doc_id", "left").select(
        "doc_id", "first", F.when(F.col("texts").isNull(), F.col("n")).alias("n"))
    told = found.where("told").groupBy("doc_id").agg(F.max("entry").alias("common"))
    points = staged(found.where("NOT told").join(info.join(told, "doc_id", "left"), "doc_id").groupBy(
        "entry", F.col("first").alias("doc_id")).agg(
        F.max("n").alias("n"), F.max("common").alias("common")), "points")
    linked = similar_pairs(docs, points, scheme)
    shared = info.groupBy("doc_id").agg(
        F.min("first").alias("a"), F.max("first").alias("z")).where("a <> z").join(
        info.select("doc_id", F.col("first").alias("b")), "doc_id").select("a", "b")
    groups = components(linked.unionAll(shared))
    return named.join(groups.withColumnRenamed("node", "first"), "first", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "first").alias("component_id"))


def enough_shared(met: DataFrame, plain: Column) -> DataFrame:
    """The pairs (doc_id, other) that meet in enough entries."""
    return met.groupBy("doc_id", "other").agg(F.count("*").alias("shared"), *(
        F.max(c).alias(c) for c in ("n", "common", "other_n", "other_common"))).where(
        F.col("shared") >= shared_least(plain)).select("doc_id", "other")


def references(seen: DataFrame, points: DataFrame) -> DataFrame:
    """For documents that were compared, one that they were compared with (with), the one that most
    were, and how many of its frequent shingles they have (near). A set that others were compared
    with may stand for itself."""
    often = seen.groupBy("owner").agg(F.count("*").alias("times"))
    own = points.where("common IS NOT NULL AND n IS NOT NULL").groupBy("doc_id").agg(
        F.max("common").alias("near")).join(often.withColumnRenamed("owner", "doc_id"), "doc_id").select(
        "doc_id", F.col("doc_id").alias("with"), "near", "times")
    others = seen.join(often, "owner").select(
        F.col("other").alias("doc_id"), F.col("owner").alias("with"), F.col("frequent").alias("near"), "times")
    return own.unionAll(others).groupBy("doc_id").agg(F.max(F.struct("times", "with", "near")).alias("top")
        ).select("doc_id", "top.with", "top.near")


def similar_pairs(docs: DataFrame, points: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) that connect all that is similar among ``points`` (entry, doc_id, n, common)."""
    plain = F.lit(not scheme.deleting)
    # The most typical set of an entry has the most frequent shingles, or else meets others in the
    # most entries.
    met = points.groupBy("doc_id").agg(F.count("*").alias("met"))
    lead = points.join(met, "doc_id").groupBy("entry").agg(F.max(F.struct(
        F.coalesce("common", F.lit(-1)).alias("most"), "met", (-F.col("doc_id")).alias("low"), "n",
        "common")).alias("top")).select(
        "entry", (-F.col("top.low")).alias("other"), F.col("top.n").alias("other_n"),
        F.col("top.common").alias("other_common"), F.lit(None).cast("long").alias("other_with"),
        F.lit(None).cast("long").alias("other_near"))
    points_only = points.withColumns({c: F.lit(None).cast("long") for c in ("with", "near")})
    first = staged(enough_shared(points_only.join(lead, "entry").where(
        (F.col("doc_id") != F.col("other")) & may_meet()), plain).select(
        F.col("other").alias("owner"), F.col("doc_id").alias("other")), "first-pairs")
    seen = staged(compare(docs, first, scheme), "compared")
    found = similar_only(seen)
    groups = components(found)
    labelled = points.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(
        references(seen, points), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    split = labelled.groupBy("entry").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rest = staged(labelled.join(split.select("entry"), "entry"), "open-points")
    other = rest.select("entry", F.col("doc_id").alias("other"), F.col("n").alias("other_n"),
                        F.col("common").alias("other_common"),
                        F.col("with").alias("other_with"), F.col("near").alias("other_near"),
                        F.col("component").alias("other_component"))
    more = enough_shared(rest.join(other, "entry").where(
        (F.col("doc_id") < F.col("other")) & (F.col("component") != F.col("other_component"))
        & may_meet()), plain).select(F.col("doc_id").alias("owner"), "other")
    done = first.select(F.least("owner", "other").alias("owner"),
                        F.greatest("owner", "other").alias("other")).distinct()
    return found.unionAll(similar_only(compare(
        docs, more.join(done, ["owner", "other"], "left_anti"), scheme)))
