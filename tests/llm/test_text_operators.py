"""Rules, spans, languages and models on whole texts."""

import os
import random
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from eventmart.llm import language_id, pii, quality_model, quality_rules, toxicity

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def by_patterns(text):
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text)
              if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    found += [("phone", m) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in found),
                  key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def test_spans_equal_the_patterns():
    rng, cues = random.Random(1), pii.anchors()
    for _ in range(20_000):
        text = "".join(rng.choice("aé1 .-@+(01@.9") for _ in range(rng.randint(0, 40)))
        assert [s for s in pii.find_spans(text, cues) if s[0] in pii.BASE_KINDS] == by_patterns(text)


def test_added_spans_and_redaction():
    text = ("IBAN: DE89 3704 0044 0532 0130 00, ssn 078-05-1120, mailto:a.b@c.de. "
            "https://me:pw@host.org/x?y=1 and https://host.org/x")
    found = pii.find_spans(text, pii.anchors())
    kinds = [text[a:b] for k, a, b in found if k not in pii.BASE_KINDS]
    assert kinds == ["DE89 3704 0044 0532 0130 00", "078-05-1120", "mailto:a.b@c.de",
                     "https://me:pw@host.org/x?y=1"]
    assert pii.redacted("x a@b.c y", [("email", 2, 7)]) == "x <EMAIL> y"


def test_redact_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd", "s"), (2, None, None)],
                                 "doc_id long, text string, source string")
    assert [tuple(r) for r in pii.redact(docs).orderBy("doc_id").collect()] == [
        (1, "mail <EMAIL>", "s"), (2, None, None)]


def test_repeated_words_by_marking():
    rng = random.Random(2)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        marked = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert quality_rules.repeated_words(words) == len(marked)


def test_compression_bands():
    press, rng = zstandard.ZstdCompressor(level=3), random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    plain = " ".join(rng.choice(words) for _ in range(600))
    noise = " ".join("".join(rng.choice([chr(c) for c in range(192, 8000)]) for _ in range(6))
                     for _ in range(400))
    half = plain + " " + " ".join("abcdefgh"[i % 8] * 3 + str(i % 3) for i in range(9000))
    assert quality_rules.judge(plain, press)[6]
    assert not quality_rules.judge("same line here. " * 300, press)[6]
    assert not quality_rules.judge(noise, press)[6]
    assert not quality_rules.judge(half, press)[6]
    assert [len(c) for c in quality_rules.split_chunks(b"x" * 9000)] == [4096, 4904]


def test_compression_bands_of_other_scripts():
    press, rng = zstandard.ZstdCompressor(level=3), random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (30, 100, 300, 600, 3000)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    for first in (0x3B1, 0x430, 0x5D0, 0x905, 0xE01):  # Greek, Cyrillic, Hebrew, Devanagari, Thai
        other = str.maketrans(letters, "".join(chr(first + i) for i in range(26)))
        for text in texts:
            assert quality_rules.judge(text, press)[6] and quality_rules.judge(text.translate(other), press)[6]
        assert not quality_rules.judge("same line here. ".translate(other) * 300, press)[6]
        even = " ".join("".join(chr(first + rng.randrange(26)) for _ in range(70)) for _ in range(60))
        assert not quality_rules.judge(even + " " + texts[0], press)[6]
    assert quality_rules.recoded("naïve я") == "naïve b".encode()
    assert [len(quality_rules.recoded(x)) for x in ("한글", "漢字")] == [6, 4]
    assert [len(c) for c in quality_rules.split_chunks("я".encode() * 4500)] == [4096, 4904]
    assert [len(c) for c in quality_rules.split_chunks("a".encode() + "я".encode() * 4500)] == [4097, 4904]


def test_limits_are_continuous():
    limits = quality_rules.Limits((10, 1000), (1.0, 4.0), (2.0, 8.0))
    assert limits.hold(100, 2.0) and limits.hold(100, 4.0)
    assert not limits.hold(100, 1.99) and not limits.hold(100, 4.01)
    assert limits.hold(0, 1.0) and limits.hold(10, 2.0) and limits.hold(10**9, 8.0) and not limits.hold(5, 2.1)
    for known in (quality_rules.WHOLE_LIMITS, quality_rules.CHUNK_LIMITS):
        assert all(a < b for a, b in zip(known.lowest, known.highest, strict=True))


def prose(rng, n):
    words = ["".join(rng.choice("eeetttaaoooiinnsshhrrddlucmfwypvbgk") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    return [rng.choice(words) for _ in range(n)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_verdicts_on_labelled_rows(spark):
    """Of texts that pass the base rule, clean ones stay and most bad ones go."""
    read = [spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels")]
    found = quality_rules.compression_verdicts(read[0]).where("NOT base_failed").join(
        read[1].where("quality IS NOT NULL"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()
    share = {r.quality: r.share for r in found}
    assert share[1] >= 0.98 and share[0] <= 0.4


def test_chunks_are_judged_on_their_own():
    """Half of the chunks repeat one line: the whole ratio alone may pass, its chunks do not."""
    press, rng = zstandard.ZstdCompressor(level=3), random.Random(6)
    plain, odd = " ".join(prose(rng, 2000)), "".join(rng.choice("abcdefgh") * 12 + " " for _ in range(900))
    wide = quality_rules.Limits((1,), (0.0,), (1000.0,))
    found = quality_rules.judge(plain + odd, press, wide)
    assert found[9] >= 4 and found[10] > found[9] / 4 and not found[6]
    assert quality_rules.judge(plain, press, wide)[10] == 0
    assert quality_rules.judge(plain + odd, press, wide, wide)[6]


def test_base_columns_by_brute_force(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab é|#\n\t\u2003x") for _ in range(rng.choice((0, 5, 60, 300)))) for _ in range(200)]
    texts += [None, "", "one two " * 40, " ".join(map(str, range(12)))]
    found = {r.doc_id: r for r in quality_rules.compression_verdicts(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        repeats = len({k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)})
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:k] for k, x in enumerate(lines)), repeats,
            len(words) < 10 or 100 * repeats > 20 * len(words))
        assert not (r.kept and r.base_failed)


def test_keep_returns_the_rows(spark):
    good = " ".join(prose(random.Random(8), 120))
    docs = spark.createDataFrame([(1, "one two " * 40, "s"), (2, None, "s"), (3, "a b", "s"), (4, good, "t")],
                                 "doc_id long, text string, source string")
    assert [tuple(r) for r in quality_rules.keep(docs).collect()] == [(4, good, "t")]


def test_trigrams_are_counted_inside_texts():
    both = language_id.trigram_counts(["Ab c", "xy"])
    assert (both[0] == language_id.trigram_counts(["ab c"])[0]).all() and both.sum(1).tolist() == [4, 2]


def test_mixtures():
    english, german = "the cat and the dog were there with them ", "der hund und die katze sind nicht da "
    counts = language_id.trigram_counts([english * 20, german * 20]) + language_id.SMOOTHING
    model = language_id.Languages(["de", "en"], (counts / counts.sum(1, keepdims=True))[::-1])
    shares = language_id.proportions(language_id.trigram_counts(
        [english, german, english * 6 + german * 3]), model)
    assert shares.argmax(1).tolist() == [1, 0, 1]
    assert (shares[:2] > 0).sum(1).tolist() == [1, 1] and 0.55 < shares[2, 1] < 0.8


def test_isotonic_is_the_nearest_rising_sequence():
    rng = np.random.default_rng(4)
    for _ in range(50):
        y, w = rng.normal(size=12), rng.integers(1, 5, 12).astype(float)
        found = quality_model.isotonic(y * w, w)
        # The largest over starts of the smallest over ends of the means of stretches.
        means = [[(y[a:b + 1] * w[a:b + 1]).sum() / w[a:b + 1].sum() if b >= a else np.inf
                  for b in range(12)] for a in range(12)]
        wanted = [max(min(means[a][b] for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(found, wanted)


def test_normal_equations_sum_over_partitions(spark):
    rng = np.random.default_rng(5)
    stats = rng.normal(size=(40, quality_model.STATISTICS)).astype("<f4")
    labels = rng.integers(0, 2, 40).astype(float)
    rows = spark.createDataFrame([(bytearray(s.tobytes()), float(y)) for s, y in zip(stats, labels, strict=True)],
                                 "stats binary, label double").repartition(5)
    mean, scale = quality_model.moments(rows)
    wide = stats.astype(float)
    assert np.allclose(mean, wide.mean(0)) and np.allclose(scale, wide.std(0))
    waves = quality_model.Fourier.draw(mean, scale, 8)
    x = waves(stats)
    assert np.allclose(quality_model.normal_equations(rows, waves), x.T @ np.c_[x, labels])


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6, 5))
    waves = quality_model.Fourier.draw(np.zeros(5), np.ones(5), 20_000)(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.allclose(waves @ waves.T, np.exp(-distance / 10), atol=0.05)


def test_gradients_equal_differences():
    rng = np.random.default_rng(7)
    words = "the idiot hello wörld a fine day café".split()
    inputs = toxicity.Inputs.of(words)
    w = {k: v.astype(float) for k, v in toxicity.new_weights().items()}
    ids = rng.integers(0, len(words), (4, toxicity.WINDOW))
    ids[2, 10:] = -1
    labels = np.array([1.0, 0, 1, 0])
    _, g = toxicity.loss_gradients(inputs, ids, labels, w)
    for name in w:
        at = {"word": (inputs.words[3], 2), "piece": (inputs.pieces[5], 3)}.get(
            name, tuple(rng.integers(0, n) for n in w[name].shape))
        start, step = w[name][at], 1e-2
        w[name][at] = start + step
        up = toxicity.loss_gradients(inputs, ids, labels, w)[0]
        w[name][at] = start - step
        down = toxicity.loss_gradients(inputs, ids, labels, w)[0]
        w[name][at] = start
        assert abs((up - down) / (2 * step) - g[name][at]) < 1e-4, name


def test_windows_cover_every_stretch():
    for n in (1, 5, 24, 25, 40, 41, 100):
        first = toxicity.starts(n)
        spans = [(a, min(n, a + toxicity.WINDOW)) for a in first]
        for a in range(n):
            assert any(s <= a and min(n, a + 8) <= e for s, e in spans)
    assert toxicity.starts(0) == []


def test_windows_overlap_by_half():
    longest = toxicity.WINDOW // 2 + 1
    for n in range(1, 120):
        spans = [(a, min(n, a + toxicity.WINDOW)) for a in toxicity.starts(n)]
        for a in range(max(1, n - longest + 1)):
            assert any(s <= a and min(n, a + longest) <= e for s, e in spans)


def test_training_finds_the_word_and_its_stem():
    rng = random.Random(8)
    calm = ["".join(rng.choice("etaoinshrdlu") for _ in range(5)) for _ in range(60)]
    texts, labels = [], []
    for i in range(160):
        words = [rng.choice(calm) for _ in range(rng.randint(20, 80))]
        if i % 2:
            words[rng.randrange(len(words))] = rng.choice(["vermin", "grubber" + rng.choice(calm)[:2]])
        texts.append(" ".join(words))
        labels.append(i % 2)
    scorer = toxicity.Scorer(toxicity.train(texts, labels))
    clean = " ".join(rng.choice(calm) for _ in range(200))
    found = scorer([clean, clean + " vermin", "grubberxyz " + clean, ""])
    assert found[0] < 0.5 < min(found[1:3]) and found[3] < 1e-6


def test_long_texts_make_room_for_short_ones(spark):
    docs = spark.createDataFrame([(i, "calm " * (2000 if i % 2 else 20) + str(i)) for i in range(40)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)], "doc_id long, toxic int")
    assert sorted(y for _, y in toxicity.training_rows(docs, labels, "toxic", 1 << 30, rows=10)) == [0] * 10 + [1] * 10


def test_repeated_rows_do_not_travel(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, "another")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    taken = []
    frame = type(docs)
    collect = frame.collect
    frame.collect = lambda df: taken.append(collect(df)) or taken[-1]
    try:
        toxicity.training_rows(docs, labels, "toxic", 1 << 30)
    finally:
        frame.collect = collect
    assert sum(map(len, taken)) == 4
