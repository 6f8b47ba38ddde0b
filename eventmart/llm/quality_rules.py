"""Quality rules from compression: text that zstandard shrinks far more, or far less, than text
of its length should is repetitive or noise.

The whole text and each chunk of 4 KiB are compressed on their own. A ratio (bytes before by
bytes after) grows with the length, and scatters less the longer a text is, so its limits are curves over
the length, given at powers of two and straight between them on logarithmic scales. A text is kept if its
whole ratio is within its limits and at most a quarter of its chunks are outside of theirs. Plain
counts of words, symbols and repeats come with it.

The limits were set from Latin script. UTF-8 spends two or three bytes, the first of them nearly
constant, on letters of other scripts, and these bytes shrink to nothing. There one symbol per
letter is judged instead (``recoded``). Both ratios are returned: that of UTF-8 and the judged one.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from eventmart.llm.common import (
    arrow_schema, chunks, columns, documents, in_small_batches, numbered, record_batch)

@dataclass(frozen=True)
class Limits:
    """Lowest and highest ratio at some lengths; a length between two has limits between theirs, one beyond
    the first or last has that one's."""

    lengths: tuple[int, ...]
    lowest: tuple[float, ...]
    highest: tuple[float, ...]

    def hold(self, length: int, ratio: float) -> bool:
        i = bisect(self.lengths, length)
        if i in (0, len(self.lengths)):
            i = max(i - 1, 0)
            return self.lowest[i] <= ratio <= self.highest[i]
        way = math.log(length / self.lengths[i - 1]) / math.log(self.lengths[i] / self.lengths[i - 1])
        low, high = (side[i - 1] * (side[i] / side[i - 1]) ** way for side in (self.lowest, self.highest))
        return low <= ratio <= high


# Fixed values, set from clean labelled texts: nearly all of them lie within at every length. Short texts
# have room, as a few words say little; of long ones the chunks decide.
WHOLE_LIMITS = Limits(
    (32, 64, 128, 256, 640, 1024, 2048, 4096, 8192, 16384, 65536, 1048576),
    (0.50, 0.68, 0.89, 1.11, 1.30, 1.48, 1.67, 1.82, 1.90, 1.95, 1.98, 1.98),
    (1.00, 1.30, 1.60, 1.78, 1.95, 2.00, 2.14, 2.27, 2.45, 2.75, 2.95, 3.30))
#: Of chunks, which begin and end anywhere. Few clean texts have more than one beyond them.
CHUNK_LIMITS = Limits((1024, 2048, 4096, 5120), (1.50, 1.64, 1.76, 1.78), (2.02, 2.18, 2.30, 2.34))
CHUNK_BYTES = 4096
#: A last piece under this size belongs to the chunk before it.
LEAST_CHUNK_BYTES = 1024
BAD_CHUNK_SHARE = 0.25
LEVEL = 3
#: The bytes that letters beyond Latin ones take, in this order, as far as a text leaves them free;
#: from IDEOGRAPHS and from RARE on, 32 bytes each lead a pair.
LATIN, BEYOND_LATIN = "\u017f", re.compile("[^\x00-\u017f]")
IDEOGRAPHS, RARE = 192, 224
PLACES = sorted(map(chr, range(IDEOGRAPHS)), key=lambda c: (not "a" <= c <= "z", not "A" <= c <= "Z", c))
SYMBOLS = "#*$%&|<>"
WHITE_SPACE = " \t\n\v\f\r"
WINDOW = 5

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
          "judged_ratio double, n_chunks long, n_bad_chunks long")


def repeated_words(words: Sequence[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more, all occurrences counted."""
    windows = list(zip(*(words[i:] for i in range(size)), strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered = end = 0
    for start, window in enumerate(windows):
        if seen[window] > 1:
            covered += start + size - max(start, end)
            end = start + size
    return covered


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(WHITE_SPACE)]
    return len(lines) - len(set(lines))


def split_chunks(raw: bytes, size: int = CHUNK_BYTES, least: int = LEAST_CHUNK_BYTES) -> list[bytes]:
    """Pieces of about ``size`` bytes of UTF-8; one that would begin inside a letter begins behind it."""
    starts = list(range(0, len(raw), size)) or [0]
    if len(starts) > 1 and len(raw) - starts[-1] < least:
        starts.pop()
    for i, a in enumerate(starts):
        while a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        starts[i] = a
    found = [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)]
    return [piece for piece in found if piece]


def recoded(text: str) -> bytes:
    """The text with one symbol, a byte, for each letter of scripts other than Latin.

    Latin letters stay as they are in UTF-8, which the limits were set from. Others take free bytes in
    order of first appearance, letters before signs, so a one-to-one change of letters changes next
    to nothing. Syllables of Hangul are taken apart into letters, and ideographs, which tell about as
    much as two letters, are two symbols. When a text has more letters than bytes are free, the later
    ones are two as well.
    """
    if not BEYOND_LATIN.search(text):
        return text.encode()
    seen = dict.fromkeys(text)
    free = (c for c in PLACES if c >= "\x80" or c not in seen)
    letters: dict[str, str] = {}
    codes: dict[int, str] = {}
    n_ideographs = n_rare = 0
    for c in seen:
        if c <= LATIN:
            codes[ord(c)] = c.encode().decode("latin-1")
            continue
        if "\u3400" <= c <= "\u9fff" or "\uf900" <= c <= "\ufaff" or "\U00020000" <= c <= "\U0003ffff":
            codes[ord(c)] = chr(IDEOGRAPHS + (n_ideographs >> 8) % 32) + chr(n_ideographs & 255)
            n_ideographs += 1
            continue
        parts = unicodedata.normalize("NFD", c) if "\uac00" <= c <= "\ud7a3" else c
        for x in parts:
            if x not in letters:
                place = next(free, None)
                if place is None:
                    place = chr(RARE + (n_rare >> 8) % 32) + chr(n_rare & 255)
                    n_rare += 1
                letters[x] = place
        codes[ord(c)] = "".join(letters[x] for x in parts)
    return text.translate(codes).encode("latin-1")


Judged = tuple[int, int, int, int, int, bool, bool, float, float, int, int]


def judge(text: str, press: zstandard.ZstdCompressor, whole: Limits = WHOLE_LIMITS,
          chunk: Limits = CHUNK_LIMITS) -> Judged:
    """The columns of SCHEMA after doc_id, for one text."""
    def ratio(piece: bytes) -> float:
        return len(piece) / len(press.compress(piece)) if piece else 0.0

    raw = text.encode()
    words = raw.split()
    repeats = repeated_words(words)
    failed = len(words) < 10 or 100 * repeats > 20 * len(words)
    symbols = recoded(text)
    judged = ratio(symbols)
    fit = whole.hold(len(symbols), judged)
    pieces = split_chunks(raw)
    if len(pieces) < 2:
        bad = int(bool(pieces) and not fit)
    else:
        parts = [recoded(p.decode()) for p in pieces]
        bad = sum(not chunk.hold(len(p), ratio(p)) for p in parts)
    kept = not failed and fit and bad <= BAD_CHUNK_SHARE * len(pieces)
    return (len(words), len(text) - sum(map(text.count, WHITE_SPACE)),
            sum(map(text.count, SYMBOLS)), repeated_lines(text), repeats, failed, kept,
            judged if symbols == raw else ratio(raw), judged, len(pieces), bad)


def compression_verdicts(docs: DataFrame, whole: Limits = WHOLE_LIMITS,
                         chunk: Limits = CHUNK_LIMITS) -> DataFrame:
    """One row per document: counts, both ratios, chunks outside their limits, and the verdict.

    Null and empty texts have no words, ratio 0 and no chunks, and fail by length. Repeated
    rows each get a row; a null id stays null. Of the input only doc_id and text are read, so
    other columns may have any names. No row in, no row out.
    """
    out = arrow_schema(SCHEMA)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in chunks(batches):
            rows = [(doc_id, *judge(text or "", press, whole, chunk))
                    for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True)]
            yield record_batch(rows, out)

    return documents(docs).mapInArrow(judged, SCHEMA)


def keep(docs: DataFrame, text: str = "text", whole: Limits = WHOLE_LIMITS,
         chunk: Limits = CHUNK_LIMITS) -> DataFrame:
    """The rows whose text passes, with all their columns, which may have any names; of two named ``text``
    the first counts. Null texts go."""
    plain, names = numbered(in_small_batches(docs))
    place = names.index(text)

    def passed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in chunks(batches):
            kept = [judge(t or "", press, whole, chunk)[6] for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return plain.mapInArrow(passed, plain.schema).toDF(*names)
