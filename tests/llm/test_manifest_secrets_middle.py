"""Merkle manifests, secret scans and fill-in-the-middle against slow and simple versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import fill_in_middle, merkle, secrets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `Text` string, leaf string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest


def slow_tree(nodes, fanout):
    """The root and every node's proof, level by level over the whole tree."""
    proofs, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, place in enumerate(at):
            start = place - place % fanout
            run = level[start:start + fanout]
            run[place - start] = "*"
            proofs[i].append("".join(run))
            at[i] = place // fanout
        level = [sha("".join(level[i:i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], proofs


def slow_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(spark, rows, fanout, levels):
    docs = spark.createDataFrame(
        [(i, t, lang, s, n, "x", "y") for i, s, lang, n, t in rows], DOCS)
    return merkle.manifest(docs, FIELDS, "lang", "doc_id", fanout=fanout, levels=levels)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (3, 1)])
def test_manifest_equals_the_whole_tree(spark, fanout, levels):
    """Trees of 1 to 11 leaves in blocks of 2 or 3, so that truncated groups swap too."""
    rows = [(100 * size + i, f"s{i}", lang, i, "é" * i) for size, lang in (
        (11, "aa"), (7, "b"), (6, "Z"), (1, "é"), (3, None), (2, "")) for i in range(size)]
    rows += [(None, None, "b", None, None), (700, "again", "b", 1, ""), (700, "again", "b", 1, "")]
    random.Random(3).shuffle(rows)
    trees = {}
    for lang in {r[2] for r in rows}:
        ordered = sorted((r for r in rows if r[2] == lang), key=lambda r: (
            r[0] is not None, r[0] or 0, slow_leaf(r)))
        trees[lang] = (ordered, *slow_tree([slow_leaf(r) for r in ordered], fanout))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    root, uppers = slow_tree([trees[x][1] for x in order], fanout)
    wanted = [(r[0], slow_leaf(r), subroot, root, [*proof, *upper])
              for lang, upper in zip(order, uppers, strict=True)
              for r, proof in zip(trees[lang][0], trees[lang][2], strict=True)
              for subroot in [trees[lang][1]]]
    found = manifest(spark, rows, fanout, levels).collect()
    assert sorted(map(repr, ((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in found))) == sorted(
        map(repr, wanted))


def test_one_row_none_and_changed_rows(spark):
    only = merkle.verified(manifest(spark, [(5, "s", "en", None, "x")], 2, 2), "doc_id").collect()
    assert only[0].root == only[0].leaf == only[0].subroot and only[0].verified
    assert only[0].proof_sha256 == sha("")
    assert manifest(spark, [], 2, 2).collect() == []
    docs = spark.createDataFrame([(i, "t", "en", "s", i, "x", "y") for i in range(9)], DOCS)
    changed = merkle.manifest(docs, FIELDS, "lang", "doc_id", {
        "text": F.expr("if(doc_id = 4, 'T', text)")}, levels=1)
    assert {r.doc_id for r in merkle.verified(changed, "doc_id").collect() if not r.verified} == {4}


# Secret scans


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def slow_spans(text):
    spans = []
    for kind, pattern, group, least in secrets.SHAPES:
        spans += [(kind, *m.span()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    ok = re.compile("|".join(f"(?:{p})" for p in secrets.ALLOWED))
    for c in secrets.CLASSES:
        found = []
        for run in re.finditer(f"{secrets.RUN}{{16,}}", text):
            if ok.fullmatch(run[0]):
                continue
            word, spots = run[0].lower() if c.fold else run[0], []
            for i in range(len(word) - c.window + 1):
                part = word[i:i + c.window]
                if set(part) <= set(c.alphabet) and entropy(part) >= c.bits - 1e-9:
                    if spots and i <= spots[-1][1]:
                        spots[-1][1] = i + c.window
                    else:
                        spots.append([i, i + c.window])
            found += [(c.kind, a + run.start(), b + run.start()) for a, b in spots if not ok.fullmatch(run[0][a:b])]
        spans += [s for s in found if not any(t[1] <= s[1] and s[2] <= t[2] for t in spans)]
    kinds = [*secrets.BASE_KINDS, *(c.kind for c in secrets.CLASSES)]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def test_spans_equal_slow_ones(spark, monkeypatch):
    monkeypatch.setattr(secrets, "PIECE", 40)
    draw = random.Random(11)
    signs = [*"0123456789abcdef", "AKIA", "token=", "Secret: '", "api_key", "API-KEY", "=", " ", "é", "\n", "😀", "Zq9+/_-"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.choice((0, 3, 30, 200)))) for _ in range(150)]
    texts += ["".join(draw.choice(c.alphabet) for _ in range(n)) for c in secrets.CLASSES for n in (15, 16, 24, 39, 40, 41, 300)]
    texts += ["passwords = abcdefgh password=1234567 passwd=\"12345678 key", "AKIA1234567890A AKIA123456789012",
              "f" * 31, "f" * 32, "0" * 40, "1" * 20 + "a" * 20, "id 123e4567-e89b-12d3-a456-426614174000",
              "some/path/that/only-has_letters/and/goes/on", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "", None,
              "a" * 5000 + "".join(draw.choice("0123456789abcdef") for _ in range(500))]
    docs = spark.createDataFrame([(i, t, *[None] * 5) for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.secret_spans(docs).collect()}
    for i, text in enumerate(texts):
        assert found[i] == slow_spans(text or ""), text
    assert sum(any(s[0].startswith("random") for s in spans) for spans in found.values()) > 20


def test_secret_digests(spark):
    docs = spark.createDataFrame([(None, "é token: abcdefgh1 " + "0f" * 16, *[None] * 5), (2, None, *[None] * 5)], DOCS)
    found = {r.doc_id: r for r in secrets.digests(secrets.secret_spans(docs)).collect()}
    assert (found[None].n_assign, found[None].n_access, found[None].n_hex) == (1, 0, 1)
    assert found[None].spans == "assign:2:18,hex:19:51" and found[None].base_sha256 == sha(found[None].spans)
    assert (found[2].spans, found[2].base_sha256) == ("", sha(""))
    assert secrets.secret_spans(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x", *[None] * 5)], DOCS)
    plan = secrets.digests(secrets.secret_spans(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# Fill in the middle


def test_index_converts_both_ways():
    draw = random.Random(2)
    for _ in range(200):
        text = "".join(draw.choice("aé€😀\n") for _ in range(draw.randrange(12)))
        index = fill_in_middle.Exceptions.of(text.encode())
        places = np.arange(len(text) + 1)
        offsets = [len(text[:i].encode()) for i in places]
        assert index.n == len(text)
        assert index.bytes_at(places).tolist() == offsets
        assert index.places_at(np.array(offsets)).tolist() == places.tolist()


def slow_middle(doc_id, text):
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_transform_and_restore(spark):
    draw = random.Random(4)
    signs = ["a", "é", "€", "😀", "\n", "<", "<S", "<P", ">", "M>", "\0"]
    rows = [(i, "".join(draw.choice(signs) for _ in range(draw.randrange(40)))) for i in range(300)]
    rows += [(1001, None), (1002, ""), (1003, "a<M>b"), (None, "no id"), (1004, "x"), (1004, "x"), (1005, "word é " * 30_000)]
    found = fill_in_middle.restore(fill_in_middle.transform(
        spark.createDataFrame([(i, t, *[None] * 5) for i, t in rows], DOCS))).collect()
    assert len(found) == len(rows)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found), key=repr) == sorted(
        ((i, len(t or ""), *slow_middle(i, t or ""), t or "") for i, t in rows), key=repr)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(spark.createDataFrame([], DOCS)).collect() == []
