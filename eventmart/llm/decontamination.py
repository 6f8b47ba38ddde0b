"""Benchmark passages in documents: a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of 13 words (all its words, if it has fewer). Windows and documents
are taken as sets of shingles, runs of up to four words. A document holds a window only if it has
all of the window's shingles in order, so one necessary shingle, the rarest in the corpus, is
enough to find every candidate; bounds on positions and length follow from where that shingle
stands in the window, and each candidate is verified over the whole window, word by word.

Documents are read once. A filter of fixed size, built from the benchmark's shingles, passes the
few positions of a document that may hold one; an exact comparison of words removes its errors.
What is left, positions of benchmark shingles in documents, is written to the shared folder, and
counts of rarity, candidates and verification all work on that small table. Nothing is broadcast
by choice: joins go by Spark's own measured sizes, and the filter's size does not depend on data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import pick, staged

WINDOW = 13
SHINGLE = 4
#: The filter has 64 times so many bits: 128 KiB.
FILTER_WORDS = 1 << 14
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A document counts as contaminated if at least one in so many of its words is hit.
SHARE = 20


def words_of(text: str) -> Column:
    """The words of a text, A-Z in lower case and all other characters as they are; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def hash_at(words: Column, at: Column, size: int) -> Column:
    """The hash of ``size`` words from position ``at`` (from 0)."""
    return F.xxhash64(*(F.get(words, at + i) for i in range(size)))


def slot_of(h: Column) -> Column:
    return F.shiftright(h, 6).bitwiseAND(FILTER_WORDS - 1).cast("int")


def bit_of(h: Column) -> Column:
    return h.bitwiseAND(63).cast("int")


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, words, n, k) with k words to a shingle, and which item has which
    (item_id, window)."""
    items = pick(benchmark, item_id="item_id", text="text").select(
        F.col("item_id").cast("string").alias("item_id"), words_of("text").alias("words")
    ).where("item_id IS NOT NULL AND size(words) > 0")
    found = items.select("item_id", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(words) - {WINDOW}, 0)), "
        f"i -> slice(words, i + 1, {WINDOW}))")).alias("words"))
    windows = staged(found.select("words").distinct().select(
        F.monotonically_increasing_id().alias("window"), "words", F.size("words").alias("n"),
        F.least(F.lit(SHINGLE), F.size("words")).alias("k")), "windows")
    return windows, found.join(windows, "words").select("item_id", "window").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """A row per window and position in it: the shingle there, with n and k of the window."""
    return windows.select("window", "n", "k", F.posexplode(F.expr(
        "transform(sequence(0, n - k), i -> array_join(slice(words, i + 1, k), ' '))")
    ).alias("at", "shingle"))


def filter_bits(known: DataFrame, sizes: list[int]) -> Column:
    """An array of FILTER_WORDS longs with a bit for each shingle (k, shingle), as a constant.

    The driver gets at most one long per slot; their number does not depend on the data.
    """
    words = F.split("shingle", " ")
    h = F.coalesce(*(F.when(F.col("k") == k, hash_at(words, F.lit(0), k)) for k in sizes))
    rows = known.select(slot_of(h).alias("slot"), bit_of(h).alias("bit")).distinct().groupBy(
        "slot").agg(F.sum(F.expr("CASE WHEN bit = 63 THEN -9223372036854775807L - 1 "
                                 "ELSE shiftleft(1L, bit) END")).alias("bits")).collect()
    bits = [0] * FILTER_WORDS
    for slot, value in rows:
        bits[slot] = value
    return F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")


def passing(words: Column, k: int, bits: Column) -> Column:
    """The positions (from 0) whose shingle of k words passes the filter, with the shingle."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: hash_at(words, i, k))
    at = F.filter(F.transform(hashes, lambda h, i: F.when(
        F.getbit(F.get(bits, slot_of(h)), bit_of(h)) == 1, i)), lambda i: i.isNotNull())
    found = F.transform(at, lambda i: F.struct(
        i.alias("at"), F.array_join(F.slice(words, i + 1, k), " ").alias("shingle")))
    return F.when(F.size(words) >= k, found)


def marked_documents(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, a number for the row, n_words and the positions that pass the filter (null: none).
    This is the one time that texts are read."""
    sizes = sorted(r.k for r in known.select("k").distinct().collect())  # SHINGLE of them at most
    words = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), words_of("text").alias("words"))
    nothing = F.lit(None).cast("array<struct<at: int, shingle: string>>")
    if sizes:
        bits = filter_bits(known, sizes)
        parts = [F.coalesce(passing(F.col("words"), k, bits), F.array().cast(
            "array<struct<at: int, shingle: string>>")) for k in sizes]
        found = F.concat(*parts)
    else:
        found = nothing
    return words.select("doc_id", F.monotonically_increasing_id().alias("row"),
                        F.size("words").cast("long").alias("n_words"), found.alias("found"))


def occurrences(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """row, window, start and n of every occurrence of a window.

    ``hits`` (row, n_words, at, shingle) are all benchmark shingles in documents. A window's rarest
    shingle proposes occurrences; windows with a shingle that no document has propose none.
    """
    seen = hits.groupBy("shingle").agg(F.count("*").alias("seen"))
    prefix = shingles.join(seen, "shingle").groupBy("window", "n", "k").agg(
        F.min_by(F.struct("shingle", "at"), F.struct("seen", "at")).alias("rarest"),
        F.count("*").alias("found")).where("found = n - k + 1").select(
        "window", "n", "k", F.col("rarest.shingle").alias("shingle"),
        F.col("rarest.at").alias("offset"))
    candidates = hits.join(prefix, "shingle").select(
        "row", "window", "n", "k", (F.col("at") - F.col("offset")).alias("start"), "n_words"
    ).where("start >= 0 AND start + n <= n_words").drop("n_words")
    wanted = candidates.join(shingles.select("window", "at", "shingle"), "window").select(
        "row", "window", "n", "k", "start", (F.col("start") + F.col("at")).alias("at"), "shingle")
    return wanted.join(hits.select("row", "at", "shingle"), ["row", "at", "shingle"]).groupBy(
        "row", "window", "n", "k", "start").agg(F.count("*").alias("held")).where(
        "held = n - k + 1").select("row", "window", "start", "n")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items (sorted as text), contaminated.

    A word is hit if it stands in an occurrence of a window; a document is contaminated if at least
    one word and a twentieth of its words are hit. Null and empty texts have no words and are
    clean. Items without words and null item ids mark nothing; items with equal ids are one item.
    Repeated documents each get a row, null ids stay null. Only doc_id, item_id and text are read.
    With an empty benchmark all documents are clean.
    """
    windows, item_windows = benchmark_windows(benchmark)
    shingles = staged(window_shingles(windows), "window-shingles")
    known = shingles.select("k", "shingle").distinct()
    marked = staged(marked_documents(docs, known), "marked")
    hits = staged(marked.select("row", "n_words", F.inline("found")).join(
        known.select("shingle"), "shingle", "left_semi"), "hits")
    found = staged(occurrences(hits, shingles), "occurrences")
    hit = found.groupBy("row").agg(F.size(F.array_distinct(F.flatten(F.collect_set(
        F.sequence("start", F.col("start") + F.col("n") - 1))))).cast("long").alias("n_hit"))
    items = found.select("row", "window").distinct().join(item_windows, "window").groupBy(
        "row").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return marked.select("doc_id", "row", "n_words").join(hit, "row", "left").join(
        items, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))
