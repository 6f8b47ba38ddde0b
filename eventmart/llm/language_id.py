"""Language identification by mixtures.

Every language has a distribution over byte trigrams (of lower-cased letters, hashed into a fixed
number of buckets), counted over all documents to learn from. A document is a mixture of languages:
expectation-maximisation estimates the proportions. Languages enter the mixture in the order of
their share in the full fit, and only as long as the gain in likelihood beats a penalty for each
further language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import arrow_schema, chunks, columns, pick, record_batch, remainder

BUCKETS = 4096
#: Added to each count, so that no trigram is impossible.
SMOOTHING = 0.5
FULL_ROUNDS = 12
SET_ROUNDS = 8
#: Log likelihood that a further language has to gain, times the log of the trigram count.
PENALTY = 3.0
UNKNOWN = "und"
ROWS = 96

#: ASCII letters in lower case, other ASCII as space, the rest as it is.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

SCHEMA = ("doc_id long, held_out boolean, lang_pred string, score double, n_languages int")


def trigram_counts(texts: Sequence[str], buckets: int = BUCKETS) -> np.ndarray:
    """A row of bucket counts per text."""
    pieces = [b" " + t.lower().encode("utf-8", "replace").translate(PLAIN) + b" " for t in texts]
    raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    if raw.size < 3:
        return np.zeros((len(texts), buckets), np.float32)
    codes = (raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]) * np.uint32(2654435761)
    slots = (codes >> np.uint32(8)) % np.uint32(buckets)
    inside = owner[:-2] == owner[2:]
    flat = np.bincount(owner[:-2][inside] * buckets + slots[inside], minlength=len(texts) * buckets)
    return flat.reshape(len(texts), buckets).astype(np.float32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Languages:
    names: list[str]
    chances: np.ndarray  # language by bucket


def learn(docs: DataFrame, buckets: int = BUCKETS) -> Languages:
    """Trigram counts per language over all rows of ``docs`` (text, lang) without a null.

    A task sums its rows into one vector per language; the sums meet by language and bucket.
    What reaches the driver is one number for each of those, whatever the input.
    """
    out = arrow_schema("lang string, bucket int, n long")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in chunks(batches, ROWS):
            texts, langs = columns(batch, "text", "lang")
            counts = trigram_counts(texts, buckets)
            for lang in set(langs):
                rows = [i for i, x in enumerate(langs) if x == lang]
                sums.setdefault(lang, np.zeros(buckets, np.int64))
                sums[lang] += counts[rows].sum(0, dtype=np.float64).astype(np.int64)
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()),
                 pa.array(total[used], pa.int64())], schema=out)

    found = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(
        counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    names = sorted(found["lang"].unique())
    counts = np.zeros((len(names), buckets))
    counts[[names.index(x) for x in found["lang"]], found["bucket"]] = found["n"]
    counts += SMOOTHING
    return Languages(names, (counts / counts.sum(1, keepdims=True)).astype(np.float32))


def fit(counts: np.ndarray, chances: np.ndarray, shares: np.ndarray,
        rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each row after so many rounds. Shares of 0 stay 0."""
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    for _ in range(rounds):
        mixed = shares @ chances
        np.divide(counts, mixed, out=mixed)
        shares = shares * (mixed @ chances.T) / total
        shares /= np.maximum(shares.sum(1, keepdims=True), 1e-30)
    return shares, np.einsum("ij,ij->i", counts, np.log(shares @ chances))


def proportions(counts: np.ndarray, model: Languages) -> np.ndarray:
    """The chosen languages' proportions per row, 0 for the others."""
    n, k = len(counts), len(model.names)
    full, _ = fit(counts, model.chances, np.full((n, k), 1 / k, np.float32), FULL_ROUNDS)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    best = (rank == 0).astype(np.float32)
    gain = np.einsum("ij,ij->i", counts, np.log(best @ model.chances))
    price = PENALTY * np.log1p(counts.sum(1))
    going = np.arange(n)
    for size in range(2, k + 1):
        start = np.where(rank[going] < size, np.maximum(full[going], 1e-3), 0).astype(np.float32)
        shares, value = fit(counts[going], model.chances,
                            start / start.sum(1, keepdims=True), SET_ROUNDS)
        better = value > gain[going] + price[going]
        going, shares, value = going[better], shares[better], value[better]
        if not len(going):
            break
        best[going], gain[going] = shares, value
    return best


def predict(docs: DataFrame, model: Languages, buckets: int = BUCKETS) -> DataFrame:
    """Language, its proportion and the number of languages, for doc_id, text and held_out."""
    out = arrow_schema(SCHEMA)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, ROWS):
            ids, texts, held = columns(batch, "doc_id", "text", "held_out")
            known = [i for i, t in enumerate(texts) if model.names and t and has_letter(t)]
            results = [(UNKNOWN, 0.0, 0)] * len(ids)
            if known:
                shares = proportions(trigram_counts([texts[i] for i in known], buckets), model)
                top = shares.argmax(1)
                for i, t, row in zip(known, top, shares, strict=True):
                    results[i] = (model.names[t], min(1.0, float(row[t])), int((row > 0).sum()))
            yield record_batch([(d, h, *r) for d, h, r in zip(ids, held, results, strict=True)], out)

    return docs.mapInArrow(judged, SCHEMA)


def identify(docs: DataFrame, parts: int = 3, held: int = 1) -> DataFrame:
    """One row per document: language, its proportion, and whether the document was held out.

    Documents whose crc32(doc_id as text) leaves ``held`` modulo ``parts`` teach nothing. A null
    lang teaches nothing either; a null, empty or letterless text is ``und`` with score 0, and so
    is everything if there is nothing to learn from. Equal shares go to the language that sorts
    first. Repeated rows each count and each get a row; a null id is held out by the crc32 of an
    empty text. Columns other than doc_id, text and lang are not read.
    """
    named = pick(docs, doc_id="doc_id", text="text", lang="lang").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
        (remainder("doc_id", parts) == held).alias("held_out"))
    model = learn(named.where("NOT held_out"))
    return predict(named.select("doc_id", "text", "held_out"), model)
