"""Quality scores from document statistics.

A Gaussian kernel over standardised statistics of a text is approximated by random Fourier
features. Each partition of the labelled rows sums its part of the normal equations; the sums meet
row by row of the matrix, and ridge weights are solved from them. Isotonic regression on labelled
rows that the fit has not seen turns raw scores into probabilities.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import arrow_schema, chunks, columns, documents, pick, remainder, staged
from eventmart.llm.quality_rules import repeated_lines, repeated_words

FEATURES = 256
RIDGE = 1e-3
SEED = 11
#: Raw scores are counted in so many steps between the limits for the calibration.
STEPS = 2000
RAW_LIMITS = (-0.5, 1.5)
PUNCTUATION = frozenset(string.punctuation.encode())
UPPER = frozenset(string.ascii_uppercase.encode())
LOWER = frozenset(string.ascii_lowercase.encode())
DIGIT = frozenset(string.digits.encode())
STATISTICS = 26


def statistics(text: str, press: zstandard.ZstdCompressor) -> list[float]:
    """The statistics of one text; all are finite, and an empty text has mostly zeros."""
    raw = text.encode()
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    lines = [x for x in text.split("\n") if x.strip()]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chances = counts[counts > 0] / size
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    per = 1 / max(1, n)
    distinct = len(set(words))

    def share(group: frozenset[int]) -> float:
        return float(counts[list(group)].sum()) / size

    ratio = len(raw) / len(press.compress(raw)) if raw else 0.0
    return [
        math.log1p(n), math.log1p(len(raw)), float(lengths.mean()), float(lengths.std()),
        float(np.log1p(lengths.max())), distinct * per, math.log1p(distinct) / max(1.0, math.log1p(n)),
        share(UPPER), share(LOWER), share(DIGIT), share(PUNCTUATION), counts[33] / size,
        counts[124] / size, float(counts[[35, 36, 37, 38, 42]].sum()) / size, counts[46] / size,
        counts[44] / size, float(counts[128:].sum()) / size,
        float(-(chances * np.log2(chances)).sum()) if raw else 0.0,
        ratio, ratio / max(1.0, math.log1p(len(raw))), repeated_words(words) * per,
        repeated_lines(text) / max(1, len(lines)), math.log1p(n / max(1, len(lines))),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) * per,
        sum(w.isupper() for w in words) * per, sum(w.istitle() for w in words) * per]


SCHEMA = "doc_id long, part int, stats binary"


def document_statistics(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, crc32 remainder and the statistics as 32-bit floats."""
    out = arrow_schema(SCHEMA)

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches):
            ids, parted, texts = columns(batch, "doc_id", "part", "text")
            stats = [np.asarray(statistics(t or "", press), "<f4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(parted, pa.int32()),
                 pa.array(stats, pa.binary())], schema=out)

    return documents(docs).select(
        "doc_id", remainder("doc_id", parts).cast("int").alias("part"), "text").mapInArrow(
        measured, SCHEMA)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("stats"))
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, STATISTICS)


@dataclass
class Fourier:
    """Cosines of random directions; inner products approximate the Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES) -> Fourier:
        rng = np.random.default_rng(SEED)
        width = math.sqrt(len(mean))
        return cls(mean, scale, rng.normal(0, 1 / width, (len(mean), features)),
                   rng.uniform(0, 2 * math.pi, features))

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        even = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = math.sqrt(2 / len(self.phases)) * np.cos(even @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(stats), 1))])


def moments(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each statistic, from sums per partition."""
    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, STATISTICS))
        for batch in batches:
            x = matrix(batch).astype(np.float64)
            total += np.stack([np.full(STATISTICS, len(x)), x.sum(0), (x * x).sum(0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(STATISTICS), pa.int32()), *(pa.array(t) for t in total)],
            names=["i", "n", "s", "q"])

    rows = train.select("stats").mapInArrow(summed, "i int, n double, s double, q double").groupBy(
        "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy(
        "i").toPandas()
    n = np.maximum(rows["n"].to_numpy(), 1)
    mean = rows["s"].to_numpy() / n
    return mean, np.sqrt(np.maximum(rows["q"].to_numpy() / n - mean ** 2, 1e-8))


def normal_equations(train: DataFrame, waves: Fourier) -> np.ndarray:
    """Sums of x x' and x y over all rows of ``train`` (stats, label), side by side.

    Every task sends one row per row of the matrix; tasks that add them up see few rows each.
    """
    out = pa.schema([("i", pa.int32()), ("sums", pa.binary())])

    def sent(total: dict[int, np.ndarray] | np.ndarray, keys: Iterable[int]) -> pa.RecordBatch:
        keys = list(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array([total[i].tobytes() for i in keys], pa.binary())],
            schema=out)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = waves(matrix(batch))
            y = np.asarray(columns(batch, "label")[0], float)
            part = x.T @ np.hstack([x, y[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield sent(total, range(len(total)))

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sums in zip(*columns(batch, "i", "sums"), strict=True):
                values = np.frombuffer(sums)
                total[i] = total[i] + values if i in total else values
        yield sent(total, total)

    rows = train.mapInArrow(partial, "i int, sums binary").repartition("i").mapInArrow(
        added, "i int, sums binary").collect()
    side = len(waves.phases) + 1
    found = np.zeros((side, side + 1))
    for i, sums in rows:
        found[i] = np.frombuffer(sums)
    return found


def isotonic(sums: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence of means nearest to the bins' means (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for s, w in zip(sums, weights, strict=True):
        blocks.append([s, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2] + n]
    return np.concatenate([np.full(int(n), s / w) for s, w, n in blocks] or [np.zeros(0)])


@dataclass
class QualityModel:
    waves: Fourier
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.waves(stats) @ self.weights

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.heights), 0, 1)


def calibrate(model: QualityModel, rows: DataFrame) -> QualityModel:
    """Isotonic heights over steps of the raw score; at most STEPS sums reach the driver. Without
    rows the raw score is taken as it is."""
    low, high = RAW_LIMITS

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(matrix(batch)), low, high)
            steps = ((raw - low) / (high - low) * (STEPS - 1)).round().astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(steps), pa.array(columns(batch, "label")[0], pa.float64())],
                names=["step", "label"])

    found = rows.mapInArrow(binned, "step int, label double").groupBy("step").agg(
        F.sum("label").alias("s"), F.count("*").alias("n")).orderBy("step").toPandas()
    if len(found):
        n = found["n"].to_numpy(float)
        heights = isotonic(found["s"].to_numpy(float), n)
        model.knots = low + found["step"].to_numpy() / (STEPS - 1) * (high - low)
        model.heights = heights
    return model


def train(stats: DataFrame, labels: DataFrame) -> QualityModel | None:
    """From ``stats`` (part not 0) and ``labels`` (doc_id, label); None without labelled rows.

    Part 1 calibrates, the other parts fit; if there is no other part, all rows do both.
    """
    labelled = staged(stats.where("part <> 0").join(labels, "doc_id").select(
        "part", "stats", "label"), "labelled")
    parts = {r.part for r in labelled.select("part").distinct().collect()}
    if not parts:
        return None
    fitted = labelled.where("part <> 1") if parts - {1} else labelled
    waves = Fourier.draw(*moments(fitted))
    sums = normal_equations(fitted, waves)
    side = len(sums)
    n = max(1.0, sums[-1, side - 1])
    weights = np.linalg.solve(sums[:, :side] / n + RIDGE * np.eye(side), sums[:, side] / n)
    model = QualityModel(waves, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return calibrate(model, labelled.where("part = 1") if 1 in parts else labelled)


RESULT = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5,
          threshold: float = 0.3) -> DataFrame:
    """One row per document: held_out, score from 0 to 1, and whether it reaches the threshold.

    Labels of documents whose crc32(doc_id as text) leaves 0 modulo ``parts`` are never used. Null
    ids and null labels teach nothing, several labels of a document count each. A null text
    counts as empty and is scored like any other; without any labelled row every score is 0.5.
    Repeated rows each get a row. Other columns than doc_id, text and the label are not read. The
    statistics are written once to the shared folder, so texts are read once.
    """
    stats = staged(document_statistics(docs, parts), "statistics")
    told = pick(labels, doc_id="doc_id", label=label).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("double").alias("label")
    ).where("doc_id IS NOT NULL AND label IS NOT NULL")
    model = train(stats, told)
    out = arrow_schema(RESULT)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parted = columns(batch, "doc_id", "part")
            found = model(matrix(batch)) if model else np.full(len(ids), 0.5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([p == 0 for p in parted], pa.bool_()),
                 pa.array(found), pa.array((found >= threshold).astype(np.int32))], schema=out)

    return stats.mapInArrow(scored, RESULT)
