"""Toxicity scores from a small recurrent network, trained and run in numpy.

A word enters as the sum of a vector of its own (hashed) and of those of its byte trigrams and its first
three to five bytes (hashed as well), these divided by the root of their number, so unseen words with a known
stem still carry meaning. Gated recurrent units read a window of words in both directions, attention
pools their states, and a logistic unit scores the pool. A text's score is that of its highest
window; windows of 24 words overlap by half, so every stretch of 13 words lies whole in some window.

Training sees whole labelled texts: of a toxic text the highest window, of a clean text its highest
windows are what the loss looks at. The word part of the input projections is computed once per
distinct word of a task and kept in a table of bounded size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import arrow_schema, chunks, columns, documents, pick, record_batch, remainder

WINDOW, STRIDE = 24, 12
WIDTH = 12
HIDDEN = 8
SLOTS = 1 << 13
#: Labelled texts used for training: at most so many of each class, of at most so many words.
TRAIN_ROWS = 2000
TRAIN_WORDS = 1200
#: Passes over them: first every window takes its text's label, then the highest windows only.
WARM_EPOCHS, EPOCHS = 2, 8
#: Few texts are passed over more often, until about so many batches have been seen.
LEAST_STEPS = 240
#: The highest windows of a clean text that are trained on; of a toxic one it is the highest.
CLEAN_WINDOWS = 3
BATCH = 256
RATE = 0.01
SEED = 5
#: A task forgets its table of words beyond this size.
TABLE_WORDS = 300_000
WINDOWS_AT_ONCE = 4096
WORDS = re.compile(r"\w+")

Weights = dict[str, np.ndarray]


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def starts(n: int) -> list[int]:
    """First words of the windows over ``n`` words: the last one ends with the text."""
    return [*range(0, n - WINDOW, STRIDE), max(0, n - WINDOW)] if n else []


def hashed(codes: np.ndarray) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(8)) % np.uint64(SLOTS)


@dataclass
class Inputs:
    """For a list of words: the slot of each word, and the slots of its character pieces."""

    words: np.ndarray
    pieces: np.ndarray
    owner: np.ndarray
    n_pieces: np.ndarray

    @classmethod
    def of(cls, words: Sequence[str]) -> Inputs:
        raw = [b"\x02" + w.encode("utf-8", "replace") + b"\x03" for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        text = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(raw)), sizes)
        place = np.arange(len(text)) - first[owner]
        powers = np.cumprod(np.full(int(sizes.max(initial=1)), 1000003, np.uint64))
        whole = np.add.reduceat((text + np.uint64(7)) * powers[place], first) if len(raw) else text
        joined = np.zeros(len(text), np.uint64)
        starts3 = np.flatnonzero(place <= sizes[owner] - 3)
        joined[starts3] = (text[starts3] << np.uint64(16) | text[starts3 + 1] << np.uint64(8)
                           | text[starts3 + 2])
        codes, owners = [joined[starts3]], [owner[starts3]]
        for k in (4, 5, 6):  # the beginning of the word, which holds its stem
            long = np.flatnonzero(sizes > k)
            code = np.full(len(long), k, np.uint64)
            for i in range(k):
                code = code * np.uint64(257) + text[first[long] + i]
            codes.append(code * np.uint64(0x2545F4914F6CDD1D))
            owners.append(long)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return cls(hashed(whole).astype(np.int64), hashed(np.concatenate(codes)).astype(np.int64)[order],
                   owner[order], np.bincount(owner, minlength=len(raw)))

    def vectors(self, w: Weights) -> np.ndarray:
        found = w["word"][self.words].copy()
        has = np.flatnonzero(self.n_pieces)
        if len(has):
            sums = np.add.reduceat(w["piece"][self.pieces],
                                   (np.cumsum(self.n_pieces) - self.n_pieces)[has])
            found[has] += sums / np.sqrt(self.n_pieces[has, None])
        return found

    def gradients(self, d: np.ndarray) -> Weights:
        scaled = (d / np.sqrt(np.maximum(self.n_pieces, 1))[:, None])[self.owner]
        return {"word": np.stack([np.bincount(self.words, d[:, j], SLOTS) for j in range(d.shape[1])], 1),
                "piece": np.stack([np.bincount(self.pieces, scaled[:, j], SLOTS)
                                   for j in range(d.shape[1])], 1)}


def new_weights(seed: int = SEED) -> Weights:
    rng = np.random.default_rng(seed)

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    w = {"word": drawn(SLOTS, WIDTH, scale=0.1), "piece": drawn(SLOTS, WIDTH, scale=0.1),
         "mix": drawn(2 * HIDDEN, HIDDEN, scale=0.3), "look": drawn(HIDDEN, scale=0.3),
         "out": drawn(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for way in "fb":
        w[f"in_{way}"] = drawn(WIDTH, 3 * HIDDEN, scale=WIDTH ** -0.5)
        w[f"back_{way}"] = drawn(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5)
        w[f"bias_{way}"] = np.zeros(3 * HIDDEN, np.float32)
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def run_gru(entering: np.ndarray, there: np.ndarray, back: np.ndarray, order: Iterable[int],
            kept: list | None = None) -> np.ndarray:
    """States after each word; places without a word keep the state. ``entering`` (n, words, 3H)
    are the input projections of the update, reset and candidate parts."""
    n, length, _ = entering.shape
    states, h = np.empty((n, length, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in order:
        x, s = entering[:, t], h @ back
        gates = sigmoid(x[:, :2 * HIDDEN] + s[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN:] + r * s[:, 2 * HIDDEN:])
        new = np.where(there[:, t, None], c + z * (h - c), h)
        if kept is not None:
            kept.append((t, h, z, r, c, s[:, 2 * HIDDEN:]))
        h = states[:, t] = new
    return states


def gru_gradients(kept: list, d_states: np.ndarray, there: np.ndarray,
                  back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``entering`` and ``back``."""
    n, length, _ = d_states.shape
    d_in, d_back = np.zeros((n, length, 3 * HIDDEN), np.float32), np.zeros_like(back)
    dh = np.zeros((n, HIDDEN), np.float32)
    for t, h, z, r, c, s in reversed(kept):
        dh = dh + d_states[:, t]
        m = there[:, t, None]
        new = dh * m
        dc = new * (1 - z) * (1 - c * c)
        d_gates = np.hstack([new * (h - c) * z * (1 - z), dc * s * r * (1 - r)])
        d_in[:, t] = np.hstack([d_gates, dc])
        d_s = np.hstack([d_gates, dc * r])
        d_back += h.T @ d_s
        dh = dh * ~m + new * z + d_s @ back.T
    return d_in, d_back


def pooled(states: np.ndarray, there: np.ndarray, w: Weights) -> tuple[np.ndarray, ...]:
    """Logits, with what the gradients need: mixed states, attention and pool."""
    mixed = np.tanh(states @ w["mix"])
    weight = np.where(there, mixed @ w["look"], -1e9)
    weight = np.exp(weight - weight.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    pool = np.einsum("nt,nth->nh", weight, states)
    return pool @ w["out"] + w["bias"][0], mixed, weight, pool


def logits(table: np.ndarray, ids: np.ndarray, w: Weights) -> np.ndarray:
    """Of windows of rows of ``table`` (input projections of both directions); -1 is no word."""
    there = ids >= 0
    entering = table[np.maximum(ids, 0)]
    states = np.concatenate([
        run_gru(entering[..., :3 * HIDDEN], there, w["back_f"], range(ids.shape[1])),
        run_gru(entering[..., 3 * HIDDEN:], there, w["back_b"], range(ids.shape[1] - 1, -1, -1))], 2)
    return pooled(states, there, w)[0]


def projections(inputs: Inputs, w: Weights) -> np.ndarray:
    vectors = inputs.vectors(w)
    return np.hstack([vectors @ w[f"in_{way}"] + w[f"bias_{way}"] for way in "fb"])


def loss_gradients(inputs: Inputs, ids: np.ndarray, labels: np.ndarray,
                   w: Weights) -> tuple[float, Weights]:
    """Mean log loss of the windows and its gradients."""
    there, n, length = ids >= 0, len(ids), ids.shape[1]
    vectors = inputs.vectors(w)
    entering = np.hstack([vectors @ w[f"in_{x}"] + w[f"bias_{x}"] for x in "fb"])[np.maximum(ids, 0)]
    kept: dict[str, list] = {"f": [], "b": []}
    ways = {"f": range(length), "b": range(length - 1, -1, -1)}
    cuts = {"f": slice(0, 3 * HIDDEN), "b": slice(3 * HIDDEN, None)}
    states = np.concatenate([run_gru(entering[..., cuts[x]], there, w[f"back_{x}"], ways[x], kept[x])
                             for x in "fb"], 2)
    logit, mixed, weight, pool = pooled(states, there, w)
    chance = sigmoid(logit)
    loss = -np.mean(np.where(labels > 0, np.log(chance + 1e-9), np.log(1 - chance + 1e-9)))
    d = ((chance - labels) / n).astype(np.float32)
    g: Weights = {"out": pool.T @ d, "bias": np.array([d.sum()])}
    d_pool = d[:, None] * w["out"]
    d_weight = np.einsum("nh,nth->nt", d_pool, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    d_mixed = d_score[..., None] * w["look"] * (1 - mixed ** 2)
    g["look"] = np.einsum("nt,nth->h", d_score, mixed)
    g["mix"] = np.einsum("nth,ntk->hk", states, d_mixed)
    d_states = weight[..., None] * d_pool[:, None] + d_mixed @ w["mix"].T
    d_vectors = np.zeros_like(vectors)
    flat = ids[there]
    for x, half in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        d_in, g[f"back_{x}"] = gru_gradients(kept[x], d_states[..., half], there, w[f"back_{x}"])
        rows = d_in[there]
        sums = np.stack([np.bincount(flat, rows[:, j], len(vectors)) for j in range(3 * HIDDEN)], 1)
        g[f"in_{x}"], g[f"bias_{x}"] = vectors.T @ sums, sums.sum(0)
        d_vectors += sums @ w[f"in_{x}"].T
    return float(loss), g | inputs.gradients(d_vectors)


class Adam:
    def __init__(self, w: Weights) -> None:
        self.first = {k: np.zeros_like(v) for k, v in w.items()}
        self.second = {k: np.zeros_like(v) for k, v in w.items()}
        self.steps = 0

    def __call__(self, w: Weights, g: Weights, rate: float) -> None:
        self.steps += 1
        for k in w:
            self.first[k] += 0.1 * (g[k] - self.first[k])
            self.second[k] += 0.01 * (g[k] ** 2 - self.second[k])
            w[k] -= rate * (self.first[k] / (1 - 0.9 ** self.steps) / (
                np.sqrt(self.second[k] / (1 - 0.99 ** self.steps)) + 1e-7)).astype(np.float32)


def window_ids(texts: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of lists of word numbers, and which text each belongs to."""
    rows, owner = [], []
    for i, ids in enumerate(texts):
        for a in starts(len(ids)):
            part = ids[a:a + WINDOW]
            rows.append(part if len(part) == WINDOW else [*part, *[-1] * (WINDOW - len(part))])
            owner.append(i)
    return np.array(rows, np.int64).reshape(-1, WINDOW), np.array(owner, np.int64)


def train(texts: Sequence[str], labels: Sequence[int]) -> Weights:
    """Weights from whole texts and their labels (0 or 1)."""
    w, numbers = new_weights(), {}
    ids, owner = window_ids([[numbers.setdefault(x, len(numbers)) for x in words_of(t)] for t in texts])
    if not len(ids):
        return w
    inputs, labels = Inputs.of(list(numbers)), np.asarray(labels, np.float32)
    rng, adam = np.random.default_rng(SEED), Adam(w)
    marks = labels[owner]
    # A text gives about three windows an epoch, and an epoch is a batch at least.
    batches = max(1, 3 * len(texts) // BATCH)
    passes = math.ceil(LEAST_STEPS / (batches * (WARM_EPOCHS + EPOCHS)))
    warm, last = WARM_EPOCHS * passes, (WARM_EPOCHS + EPOCHS) * passes
    for epoch in range(last):
        if epoch < warm:
            toxic, clean = np.flatnonzero(marks > 0), np.flatnonzero(marks == 0)
            n = max(1, min(len(toxic), len(clean), 6 * TRAIN_ROWS))
            chosen = np.concatenate([rng.permutation(toxic)[:n], rng.permutation(clean)[:n]])
        else:
            table = projections(inputs, w)
            value = np.concatenate([logits(table, ids[i:i + WINDOWS_AT_ONCE], w)
                                    for i in range(0, len(ids), WINDOWS_AT_ONCE)])
            order = np.lexsort((-value, owner))
            rank = np.arange(len(ids)) - np.searchsorted(owner[order], owner[order])
            chosen = order[rank < np.where(marks[order] > 0, 1, CLEAN_WINDOWS)]
            toxic = chosen[marks[chosen] > 0]
            again = (len(chosen) - len(toxic)) // max(1, 4 * len(toxic))  # not far rarer than clean ones
            chosen = np.concatenate([chosen, *[toxic] * (again - 1)])
        chosen = rng.permutation(chosen)
        rate = RATE * (1 - epoch / (last + 1))
        for i in range(0, len(chosen), BATCH):
            part = chosen[i:i + BATCH]
            used, local = np.unique(ids[part], return_inverse=True)
            local = local.reshape(len(part), WINDOW)
            if used[0] < 0:
                used, local = used[1:], local - 1
            _, g = loss_gradients(taken(inputs, used), local, marks[part], w)
            adam(w, g, rate)
    return w


def taken(inputs: Inputs, rows: np.ndarray) -> Inputs:
    """The inputs of some of the words."""
    first = np.cumsum(inputs.n_pieces) - inputs.n_pieces
    n = inputs.n_pieces[rows]
    owner = np.repeat(np.arange(len(rows)), n)
    at = np.arange(len(owner)) - (np.cumsum(n) - n)[owner] + first[rows][owner]
    return Inputs(inputs.words[rows], inputs.pieces[at], owner, n)


class Scorer:
    """Scores of texts; the input projections of words seen before are kept, up to a bound."""

    def __init__(self, w: Weights) -> None:
        self.w, self.numbers = w, {}
        self.table = np.empty((0, 6 * HIDDEN), np.float32)

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        if len(self.numbers) > TABLE_WORDS:
            self.numbers, self.table = {}, self.table[:0]
        known, numbers = len(self.numbers), self.numbers
        ids, owner = window_ids([[numbers.setdefault(x, len(numbers)) for x in words_of(t)]
                                 for t in texts])
        if len(numbers) > known:
            fresh = Inputs.of(list(numbers)[known:])
            self.table = np.concatenate([self.table, projections(fresh, self.w)])
        best = np.full(len(texts), -20.0)
        for i in range(0, len(ids), WINDOWS_AT_ONCE):
            np.maximum.at(best, owner[i:i + WINDOWS_AT_ONCE],
                          logits(self.table, ids[i:i + WINDOWS_AT_ONCE], self.w))
        return sigmoid(best)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int,
                  rows: int = TRAIN_ROWS) -> list[tuple[str, int]]:
    """Texts and labels of at most ``rows`` documents of each class, of at most TRAIN_WORDS
    words, those with the lowest hashes of their ids. Documents are chosen by id, length and a hash of
    the text, so only chosen texts travel, and of repeated rows one.
    """
    told = pick(labels, doc_id="doc_id", label=label).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")
    ).where("doc_id IS NOT NULL AND label IN (0, 1)").where(
        remainder("doc_id", parts) != 0).dropDuplicates()
    texts = documents(docs).where("text <> ''").withColumn("h", F.xxhash64("text"))
    sized = texts.select("doc_id", "h", F.size(F.split("text", r"\s+")).alias("words")).where(
        F.col("words") <= TRAIN_WORDS).join(
        told, "doc_id").distinct()
    order = F.xxhash64("doc_id"), "doc_id", "h"
    chosen = []
    for value in (1, 0):
        for r in sized.where(F.col("label") == value).orderBy(*order).limit(rows).collect():
            chosen.append((r.doc_id, r.h, r.label))
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, h long, label int")
    found = texts.join(F.broadcast(wanted), ["doc_id", "h"]).dropDuplicates(
        ["doc_id", "h", "label"]).select("text", "label").collect()
    return sorted({(r.text, r.label) for r in found})


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 5,
          threshold: float = 0.5) -> DataFrame:
    """One row per document: held_out, score from 0 to 1, and whether it reaches the threshold.

    Labels of documents whose crc32(doc_id as text) leaves 0 modulo ``parts`` are never used. At
    most TRAIN_ROWS labelled texts of each class, of at most TRAIN_WORDS words, are used for
    training; every document is scored whole. Null ids and labels teach nothing. A null, empty or
    wordless text scores 0. Repeated rows each get a row. Without labels of both classes nothing
    is known, and scores are 0. Other columns than doc_id, text and the label are not read.
    """
    rows = training_rows(docs, labels, label, parts)
    known = len({y for _, y in rows}) == 2
    weights = train(*zip(*rows, strict=True)) if known else None
    out = arrow_schema(SCHEMA)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Scorer(weights) if known else None
        for batch in chunks(batches, 384):
            ids, held, texts = columns(batch, "doc_id", "held_out", "text")
            values = found([t or "" for t in texts]) if known else np.zeros(len(ids))
            values = np.where(values < 1e-8, 0.0, values)
            yield record_batch([(d, h, float(v), int(v >= threshold))
                                for d, h, v in zip(ids, held, values, strict=True)], out)

    return documents(docs).select(
        "doc_id", (remainder("doc_id", parts) == 0).alias("held_out"), "text").mapInArrow(
        scored, SCHEMA)
