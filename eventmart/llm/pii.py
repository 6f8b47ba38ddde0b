"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs before a digit, digits
that touch digits or a dot, schemes and identifier cues. From each anchor a small parser of its
kind grows to both sides, stops at the boundary of that kind, and validates: digit counts and
checksums for cards and account numbers, parts for addresses. Spans are in code points with
exclusive ends.

Base kinds: ``email``, ``ip``, ``card``, ``phone``. Further kinds: ``url`` (an address with a
user or password in it, or behind ``mailto:`` or ``tel:``), ``account`` (an IBAN that passes its
check digits) and ``ssn`` (a number group behind its cue).
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.common import (
    arrow_schema, chunks, columns, documents, in_small_batches, numbered, record_batch)

DIGITS = frozenset(string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
HOST = frozenset(string.ascii_letters + string.digits + "-")
CALL = frozenset(string.digits + " ().-")
URL = frozenset(string.ascii_letters + string.digits + "-._~:/?#[]@!$&'()*+,;=%")
UPPER_OR_DIGIT = frozenset(string.ascii_uppercase + string.digits)
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "ssn")
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")
ACCOUNT_CUES = ("IBAN", "iban", "Iban")
SSN_CUES = ("SSN", "ssn", "Social Security", "social security")

Span = tuple[str, int, int]


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()

    def add(pattern: str, kind: str) -> None:
        found.add_word(pattern, (kind, len(pattern)))

    add("@", "email")
    for a in string.digits:
        add(f"+{a}", "phone")
        for b in string.digits:
            add(f"{a}.{b}", "ip")
            for gap in ("", " ", "-"):
                add(f"{a}{gap}{b}", "card")
    for scheme in SCHEMES:
        add(scheme, "url")
    for cue in ACCOUNT_CUES:
        add(cue, "account")
    for cue in SSN_CUES:
        add(cue, "ssn")
    found.make_automaton()
    return found


def run_end(text: str, at: int, allowed: frozenset[str]) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around the at-sign: local characters to the left, down to ``floor``, then two labels or more."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, HOST)
    if start == at or end == at + 1:
        return None
    dotted = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in HOST:
        end = run_end(text, end + 1, HOST)
        dotted += 1
    return (start, end) if dotted else None


def digit_run(text: str, at: int, floor: int, dotted: bool) -> list[tuple[int, int]]:
    """The groups of digits joined to the digit at ``at``: by single dots, or by single spaces and
    hyphens."""
    joins = "." if dotted else " -"
    start = at
    while start > floor and (text[start - 1] in DIGITS or (
            text[start - 1] in joins and start - 1 > floor and text[start - 2] in DIGITS)):
        start -= 1
    groups, at = [], start
    while True:
        end = run_end(text, at, DIGITS)
        groups.append((at, end))
        if end + 1 < len(text) and text[end] in joins and text[end + 1] in DIGITS:
            at = end + 1
        else:
            return groups


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    """From the plus sign to the last digit of the run of calling characters."""
    end = run_end(text, plus + 2, CALL)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (plus, end) if end > plus + 3 else None


def iban_at(text: str, at: int) -> tuple[int, int] | None:
    """The first word of capitals and digits within 12 characters of the cue, in groups joined by
    single spaces, if 15 to 34 of them pass the modulo 97 check."""
    start = at
    while start < min(len(text), at + 12) and text[start] not in UPPER_OR_DIGIT:
        start += 1
    end = run_end(text, start, UPPER_OR_DIGIT)
    ends = [end]
    while end + 1 < len(text) and text[end] == " " and text[end + 1] in UPPER_OR_DIGIT:
        end = run_end(text, end + 1, UPPER_OR_DIGIT)
        ends.append(end)
        if end - start > 50:
            break
    for end in reversed(ends):
        code = text[start:end].replace(" ", "")
        if 15 <= len(code) <= 34 and code[:2].isalpha() and code[2:4].isdigit():
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                return start, end
    return None


def ssn_at(text: str, at: int) -> tuple[int, int] | None:
    """Three, two and four digits within 12 characters of the cue."""
    start = at
    while start < min(len(text), at + 12) and text[start] not in DIGITS:
        start += 1
    groups = digit_run(text, start, start, False) if start < len(text) and text[start] in DIGITS else []
    return ((start, groups[2][1]) if len(groups) == 3
            and [b - a for a, b in groups] == [3, 2, 4] else None)


def url_at(text: str, start: int, after: int) -> tuple[int, int] | None:
    """A scheme's address, if it names a person: user data before the host, a mailbox, a number."""
    end = run_end(text, after, URL)
    while end > after and text[end - 1] in ".,;:!?)'":
        end -= 1
    scheme, rest = text[start:after], text[after:end]
    if scheme == "mailto:":
        personal = 0 < rest.find("@") < len(rest) - 1
    elif scheme == "tel:":
        personal = sum(c in DIGITS for c in rest) >= 7
    else:
        personal = rest.partition("/")[0].find("@") > 0
    return (start, end) if personal else None


def find_spans(text: str, cues: ahocorasick.Automaton) -> list[Span]:
    """All spans, by start and then kind; ``cues`` are the anchors(). Of one kind they do not overlap; base kinds are those
    that the kind's pattern finds leftmost, and a match that fails validation is passed over."""
    spans: list[Span] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in cues.iter(text):
        at = last - size + 1
        if kind == "email":
            if at >= done[kind] and (found := email_at(text, at, done[kind])):
                spans.append((kind, *found))
                done[kind] = found[1]
        elif kind == "phone":
            if at >= done[kind] and (found := phone_at(text, at)):
                done[kind] = found[1]
                if 10 <= sum(c in DIGITS for c in text[found[0]:found[1]]) <= 15:
                    spans.append((kind, *found))
        elif kind == "ip":
            if at >= done[kind]:
                groups = digit_run(text, at, done[kind], True)
                done[kind] = groups[-1][1]
                for i in range(0, len(groups) - 3, 4):
                    if all(int(text[a:b].lstrip("0")[:4] or 0) <= 255 for a, b in groups[i:i + 4]):
                        spans.append((kind, groups[i][0], groups[i + 3][1]))
        elif kind == "card":
            if at >= done[kind]:
                groups = digit_run(text, at, done[kind], False)
                done[kind] = groups[-1][1]
                digits = "".join(text[a:b] for a, b in groups)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append((kind, groups[0][0], groups[-1][1]))
        elif last + 1 > done[kind]:
            found = (url_at(text, at, last + 1) if kind == "url" else
                     iban_at(text, last + 1) if kind == "account" else ssn_at(text, last + 1))
            if found and found[0] >= done[kind]:
                spans.append((kind, *found))
                done[kind] = found[1]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: Iterable[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the
    first names them all."""
    parts, end = [], 0
    for kind, a, b in spans:
        if a >= end:
            parts += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join([*parts, text[end:]])


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
          "base_sha256 string, spans string")


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts by base kind, digest of the base spans and all spans.

    Null and empty texts have no spans. Repeated rows each get a row, null ids stay null, and
    columns other than doc_id and text are not read. No row in, no row out.
    """
    out = arrow_schema(SCHEMA)

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = anchors()
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(*columns(batch, "doc_id", "text"), strict=True):
                spans = find_spans(text or "", cues)
                base = [s for s in spans if s[0] in BASE_KINDS]
                rows.append((doc_id, *(sum(s[0] == k for s in base) for k in BASE_KINDS),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield record_batch(rows, out)

    return documents(docs).mapInArrow(found, SCHEMA)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with personal data replaced in ``text``; all other columns and null texts
    stay as they are. Columns may have any names; of two named ``text`` the first counts."""
    plain, names = numbered(in_small_batches(docs))
    place = names.index(text)

    def cleaned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = anchors()
        for batch in chunks(batches):
            texts = [None if t is None else redacted(t, find_spans(t, cues))
                     for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string()))

    return plain.mapInArrow(cleaned, plain.schema).toDF(*names)

