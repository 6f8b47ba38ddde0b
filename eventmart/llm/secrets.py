"""Secrets in text: patterns of known shapes, and strings too random to be words.

Candidates are runs of letters, digits and the signs of base 64. Over each run a window of fixed
width slides, one per character class, and counts per character go up for the one that enters and
down for the one that leaves; the sum of n*log2(n) over these counts, and so Shannon's entropy,
changes by two table entries a step. Windows of enough entropy that touch make one span. A run or
span that an allow-list pattern matches whole is left out, and so is a span inside one of an earlier kind.

Everything is DataFrame functions within a row: nothing is shuffled. A long run is cut into pieces
that overlap by a window less one, so a fold never holds more than a piece.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import pick

#: Kind, pattern, the group that is measured, and its least length.
SHAPES: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"([A-Za-z0-9+/_.=-]+)", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
BASE_KINDS = tuple(kind for kind, *_ in SHAPES)


@dataclass(frozen=True)
class CharacterClass:
    """Characters that count, the window's width and the least entropy, in bits per character, of
    a window of random ones. With ``fold`` upper case counts as lower case."""

    kind: str
    alphabet: str
    window: int
    bits: float
    fold: bool = False

    @property
    def limit(self) -> int:
        """The largest sum of n*log2(n), in fixed point, that a window of enough entropy has."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * ONE)


_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: 2^20: sums are whole numbers, which do not depend on the order of their terms.
ONE = 1 << 20
CLASSES: tuple[CharacterClass, ...] = (
    CharacterClass("random_hex", _DIGITS + "abcdef", 16, 2.75, fold=True),
    CharacterClass("random_base32", _UPPER + "234567", 20, 3.6),
    CharacterClass("random_base64", _UPPER + _UPPER.lower() + _DIGITS + "+/-_", 24, 4.0),
)
RUN = "[A-Za-z0-9+/_-]"
PIECE = 2048
#: Not secret however random they look: numbers, names and paths of letters only, and ids that are
#: random by design (version 4 UUIDs with any version digit). Examples from manuals say so.
ALLOWED: tuple[str, ...] = (
    "[0-9]+", "[A-Za-z_/-]+", ".*EXAMPLE.*",
    "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
)
SPAN = "struct<a:int,b:int>"


def weight(n: int) -> int:
    """n*log2(n) in fixed point."""
    return round(n * math.log2(n) * ONE) if n else 0


def _no_spans() -> Column:
    return F.expr(f"CAST(array() AS array<{SPAN}>)")


def _span(a: Column, b: Column) -> Column:
    return F.array(F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; a Column named twice in a lambda is computed twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str, group: int = 0, least: int = 1) -> Column:
    """Spans, in code points, of the leftmost matches whose ``group`` has ``least`` code points.

    What lies between the matches and the matches themselves take turns, so lengths add up to places.
    """
    regex = F.lit(pattern)
    turns = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("part"))

    def step(s: Column, turn: Column) -> Column:
        start = s["at"] + F.length(turn["gap"])
        end = start + F.coalesce(F.length(turn["found"]), F.lit(0))
        return F.struct(end.alias("at"), F.when(
            F.length(turn["part"]) >= least, F.concat(s["spans"], _span(start, end))).otherwise(
            s["spans"]).alias("spans"))

    spans = F.aggregate(turns, F.struct(F.lit(0).alias("at"), _no_spans().alias("spans")), step,
                        lambda s: s["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(_no_spans())


def _pieces(run: Column, size: int, overlap: int) -> Column:
    """The run as structs of place and text, each text led by the last ``overlap`` characters of the one before."""
    return _let(F.regexp_extract_all(run, F.lit(f".{{1,{size}}}"), F.lit(0)), lambda cut: F.transform(
        cut, lambda part, i: F.struct(
            F.when(i == 0, 0).otherwise(i * size - overlap).alias("at"),
            F.when(i == 0, part).otherwise(
                F.concat(F.right(F.get(cut, i - 1), F.lit(overlap)), part)).alias("text"))))


def _random_in_piece(piece: Column, kind: CharacterClass) -> Column:
    """Spans, within the run, where windows of a piece have enough entropy."""
    width = kind.window
    gains = F.array(*[F.lit(weight(n + 1) - weight(n)) for n in range(width)])
    text = F.lower(piece["text"]) if kind.fold else piece["text"]
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    steps = _let(codes, lambda all_codes: F.transform(all_codes, lambda c, i: F.struct(
        i.alias("i"), c.alias("enters"), F.get(all_codes, i - width).alias("leaves"))))

    def closed(s: Column) -> Column:
        return F.when(s["a"] >= 0, F.concat(s["spans"], _span(s["a"], s["b"]))).otherwise(s["spans"])

    def count(s: Column, x: Column, leaves: Column) -> Column:
        """The counts once x is in and, if the window was full, the oldest out; all 0 after a
        character of another class."""
        left = F.get(s["counts"], leaves)
        stays = F.get(s["counts"], x["enters"]) - (leaves == x["enters"]).cast("int")
        inside = x["enters"] >= 0
        return F.struct(
            F.transform(s["counts"], lambda n, k: F.when(inside, n + (k == x["enters"]).cast(
                "int") - (k == leaves).cast("int")).otherwise(0)).alias("counts"),
            F.when(inside, s["total"] + F.get(gains, stays) - F.when(
                leaves >= 0, F.get(gains, left - 1)).otherwise(F.lit(0))).otherwise(
                F.lit(0)).cast("long").alias("total"),
            F.when(inside, F.least(s["n"] + 1, F.lit(width))).otherwise(0).alias("n"))

    def step(s: Column, x: Column) -> Column:
        def grow(c: Column) -> Column:
            start = x["i"] - (width - 1)
            random = (c["n"] == width) & (c["total"] <= kind.limit)
            joins = random & (s["a"] >= 0) & (start <= s["b"])
            opens = random & ~joins
            return F.struct(
                c["counts"].alias("counts"), c["total"].alias("total"), c["n"].alias("n"),
                F.when(opens, start).otherwise(s["a"]).alias("a"),
                F.when(random, x["i"] + 1).otherwise(s["b"]).alias("b"),
                F.when(opens, closed(s)).otherwise(s["spans"]).alias("spans"))

        leaves = F.when(s["n"] == width, x["leaves"]).otherwise(-1)
        return _let(_let(leaves, lambda y: count(s, x, y)), grow)

    start = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("total"), F.lit(0).alias("n"), F.lit(-1).alias("a"),
        F.lit(-1).alias("b"), _no_spans().alias("spans"))
    spans = F.aggregate(steps, start, step, closed)
    return F.transform(spans, lambda x: F.struct(
        (x["a"] + piece["at"]).alias("a"), (x["b"] + piece["at"]).alias("b")))


def _touching_joined(spans: Column) -> Column:
    """Spans in order of their places, those that touch as one."""
    def step(s: Column, x: Column) -> Column:
        last = F.get(s, F.size(s) - 1)
        touches = F.coalesce(x["a"] <= last["b"], F.lit(False))
        return F.when(touches, F.concat(F.slice(s, F.lit(1), F.size(s) - 1), _span(
            last["a"], F.greatest(x["b"], last["b"])))).otherwise(F.concat(s, F.array(x)))

    return F.aggregate(spans, _no_spans(), step)


def _allowed(text: Column, allowed: Sequence[str]) -> Column:
    return text.rlike("^(?:" + "|".join(f"(?:{p})" for p in allowed) + ")$") if allowed else F.lit(False)


def _random_spans(runs: Column, kind: CharacterClass, allowed: Sequence[str]) -> Column:
    """Spans of a class over all runs of a text, but for those that are allowed."""
    def of_run(run: Column) -> Column:
        spans = _touching_joined(F.flatten(F.transform(
            _pieces(run["text"], PIECE, kind.window - 1), lambda p: _random_in_piece(p, kind))))
        kept = F.filter(spans, lambda x: ~_allowed(
            F.substring(run["text"], x["a"] + 1, x["b"] - x["a"]), allowed))
        return F.transform(kept, lambda x: F.struct(
            (x["a"] + run["at"]).alias("a"), (x["b"] + run["at"]).alias("b")))

    return F.flatten(F.transform(runs, of_run))


def _outside(spans: Column, earlier: Sequence[str]) -> Column:
    """The spans that lie inside none of the earlier kinds'."""
    def free(x: Column) -> Column:
        held = F.lit(False)
        for kind in earlier:
            held = held | F.exists(kind, lambda y: (y["a"] <= x["a"]) & (x["b"] <= y["b"]))
        return ~held

    return F.filter(spans, free)


def _ranked(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(
        x["a"].alias("start"), F.lit(rank).alias("rank"), x["b"].alias("end"), F.lit(kind).alias("kind")))


def secret_spans(docs: DataFrame, classes: Sequence[CharacterClass] = CLASSES,
                 allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """One row per document: doc_id and spans, an array of kind, start and end in code points, by
    start and then kind (base kinds, then classes in their order).

    Null and empty texts have no spans. Repeated rows each get a row, null ids stay null, and
    columns other than doc_id and text are not read, so they may have any names. No row in, no
    row out. The allow-list suppresses random strings only, never base kinds.
    """
    text = F.col("text")
    rows = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    least = min((c.window for c in classes), default=1)
    rows = rows.select("*", *[located(text, p, group, n).alias(kind) for kind, p, group, n in SHAPES],
                       located(text, f"(?<!{RUN}){RUN}{{{least},}}").alias("places"))
    rows = rows.withColumn("runs", F.filter(F.transform("places", lambda x: F.struct(
        x["a"].alias("at"), F.substring(text, x["a"] + 1, x["b"] - x["a"]).alias("text"))),
        lambda run: ~_allowed(run["text"], allowed)))
    for kind in classes:
        rows = rows.withColumn(kind.kind, _random_spans(F.col("runs"), kind, allowed))
    kinds = [*BASE_KINDS, *(c.kind for c in classes)]
    found = [_ranked(F.col(kind) if kind in BASE_KINDS else _outside(F.col(kind), kinds[:i]), i, kind)
             for i, kind in enumerate(kinds)]
    return rows.select("doc_id", F.transform(F.array_sort(F.concat(*found)), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, with commas between."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Of ``secret_spans``: counts by base kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda x: x["kind"].isin(*BASE_KINDS))
    kinds = F.transform(spans, lambda x: x["kind"])
    return found.select(
        "doc_id", *[(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
                    for kind in BASE_KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans"))
