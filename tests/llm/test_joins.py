"""Decontamination, the Jaccard join, components, packing, archives and address lists."""

import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan

from eventmart.llm import components, decontamination, filters, jaccard_join, packing, url_filters, warc
from eventmart.llm.queries import PATTERN, TOKENIZER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def contamination(text, items):
    words, hit, found = WORD.findall(lower(text)), set(), set()
    for item_id, item in items:
        grams = WORD.findall(lower(item))
        size = min(13, len(grams))
        for g in {tuple(grams[i:i + size]) for i in range(len(grams) - size + 1) if size}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) == g:
                    hit.update(range(i, i + size))
                    found.add(str(item_id))
    return len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)


def test_decontamination_by_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["Alpha", "beta", "Été", "été", "x1", "gamma"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 15, 40, 90])))
             for _ in range(60)]
    items = [(i, t) for i, t in enumerate(
        [texts[0], texts[1] + "!", "x1 x1 x1", "été", texts[2][:60], texts[3], texts[3], None, "?"])]
    items += [(20 + i, " ".join(texts[40 + i].split()[3:20])) for i in range(12)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(99, None)]
    found = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    kept = [(i, t) for i, t in items if t]
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in found} == {
        i: contamination(t, kept) for i, t in docs}


def shingle_set(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_groups(docs):
    sets, parent = {d: shingle_set(t) for d, t in docs}, {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def family(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**6)}"
        yield " ".join(words[:len(words) - rng.randint(0, len(words) // 6)])


@pytest.mark.parametrize("deleting", [False, True])
def test_jaccard_join_by_brute_force(spark, monkeypatch, deleting):
    """Families of every size around the threshold, a common line, short texts and copies; with many
    frequent shingles, few rows to a comparing task, and both kinds of segments."""
    monkeypatch.setattr(jaccard_join, "LEAST_COUNT", 3)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 5)
    if deleting:
        made = jaccard_join.make_scheme
        monkeypatch.setattr(jaccard_join, "make_scheme", lambda *a: jaccard_join.Scheme(
            *(lambda s: (s.frequent, s.rank, frozenset(range(1, 12))))(made(*a))))
    rng = random.Random(2)
    texts = [None, "", "a b", "A b", "a b c d e"]
    line = [f"line{i}" for i in range(14)]
    for size in (6, 9, 14, 18, 30, 45, 70, 150, 400):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
        texts += family(rng, base, 14, max(1, size // 25))
        texts += [" ".join(line + t.split()) for t in family(rng, base, 4, 1)]
    texts += [" ".join(line + [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 8))])
              for _ in range(25)]
    texts += texts[20:40]
    rng.shuffle(texts)
    docs = list(enumerate(texts, 100))
    found = jaccard_join.similar_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_groups(docs)


def test_entries_of_similar_sets_meet():
    """Sets that differ as much as they may share an entry, in every band and across bands."""
    rng = np.random.default_rng(3)
    for deleting in (frozenset(), frozenset(range(12))):
        for n in [*range(1, 80), 127, 128, 129, 200, 400]:
            pool = np.unique(rng.integers(0, 2**63, 2 * n + 4).astype(np.uint64))
            scheme = jaccard_join.Scheme(np.sort(rng.choice(pool, len(pool) // 3, replace=False)),
                                         rng.integers(1, 4, len(pool) // 3), deleting)
            for m in (n, n + n // 6, n + n // 3):
                both = -(-3 * (n + m) // 7)
                if both > n:
                    continue
                order = rng.permutation(len(pool))
                a = np.sort(pool[order[:n]])
                b = np.sort(pool[np.r_[order[:both], order[n:n + m - both]]])
                x, y = jaccard_join.all_entries(a, scheme), jaccard_join.all_entries(b, scheme)
                shared = np.intersect1d(x[0], y[0])
                assert len(shared), (n, m, deleting)
                if None not in (x[1], y[1]) and not (shared % 2 == 0).any():
                    assert 7 * min(x[1], y[1]) >= 3 * (n + m)


def test_rows_with_one_id_are_one_document(spark):
    a, b = ("one two three four five six seven", "red blue green pink grey black white")
    rows = [(5, a), (5, b), (3, a), (9, b), (9, b)]
    found = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in found.collect()} == {3}


def test_packed_entries_come_back():
    import zstandard
    values = np.array([5, 1 << 63, 7, 7], np.uint64)
    ids = np.array([-3, 4, 9, 2])
    got = jaccard_join.unpacked(jaccard_join.packed(values, ids, zstandard.ZstdCompressor()))
    assert sorted(zip(*map(list, got), strict=True)) == sorted(zip(values, ids, strict=True))


def test_components(spark):
    path = [(i, i + 1) for i in range(1, 40)] + [(90, 50), (90, 60), (60, 50), (None, 1), (7, 7)]
    found = components.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {**dict.fromkeys(range(1, 41), 1), 50: 50, 60: 50, 90: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_without(spark):
    rows = spark.createDataFrame([(i, "x") for i in range(20)] + [(None, "y"), (3, "z")], "doc_id long, t string")
    left = filters.without(rows, spark.createDataFrame([(3,), (15,)], "doc_id long"))
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(
        str(i) for i in [*range(20), None] if i not in (3, 15))
    assert left.columns == ["doc_id", "t"]


def test_without_keeps_its_filter_out_of_the_plan(spark):
    """The driver holds the text of plans, several times over."""
    rows = spark.range(-4000, 4000).withColumnRenamed("id", "doc_id").unionAll(
        spark.createDataFrame([(None,), (0,), (1,)], "doc_id long"))
    left = filters.without(rows, rows.where("doc_id % 2 = 0").distinct())
    assert Counter(r.doc_id for r in left.collect()) == Counter([*range(-3999, 4000, 2), None, 1])
    assert len(left._jdf.queryExecution().toString()) < 50_000
    none = filters.without(rows, rows.where("doc_id IS NULL").limit(0))
    assert none.count() == 8003


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 60, 900, 40_000):
        lengths = np.clip(rng.lognormal(5.5, 1, n).astype(int), 1, 1024)
        counts = Counter(lengths.tolist())
        made = packing.plan(counts)
        used = Counter()
        for content, k in made.contents:
            assert sum(content) <= 1024
            for length in content:
                used[length] += k
        assert used == counts
        assert made.sequences() <= max(1.05 * sum(lengths) / 1024, (lengths > 512).sum()) + 2


def test_exact_complements_fill_sequences():
    left = {1000: 2, 24: 1, 20: 1, 4: 1, 700: 1, 324: 1, 600: 1, 212: 2, 500: 3}
    found = packing.exact_complements(left, 1024)
    assert all(sum(content) == 1024 for content, _ in found) and not left[700] and not left[600]


def test_cut():
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)] and packing.cut(1, 1024) == [(0, 1)]


@pytest.mark.parametrize("block", [packing.BLOCK, 40])
def test_pack_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab é<|>\n1") for _ in range(rng.choice([0, 5, 400, 3000]))) for _ in range(80)]
    texts += ["<|endoftext|> as text", None, "x" * 5000, " " * 3000]
    docs = list(enumerate(texts))
    pieces = packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                          TOKENIZER, PATTERN, capacity=256).collect()
    whole, sequences = defaultdict(list), defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.piece):
        assert p.start == sum(map(len, whole[p.doc_id])) and p.length <= 256 and (p.piece == 0 or p.length == 256)
        whole[p.doc_id].append(np.frombuffer(p.ids, "<u4").tolist())
        sequences[p.sequence_id].append((p.offset, p.length))
    for i, text in docs:
        assert sum(whole[i], []) == encode.encode(text or "", add_special_tokens=False).ids + [2]
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 256


def test_archives_of_others_and_pushed_conditions(spark, tmp_path):
    """Members without the length field, several to a file; records that are not wanted are not decoded."""
    body = b"hello " * 4000
    record = warc.encode("response", 8, "http://a.b/c", None, None, "d", len(body), body)
    note = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(note) + gzip.compress(record) + gzip.compress(note))
    pages = spark.createDataFrame([(i, f"http://h/{i}", "y" * 200 * (i % 3)) for i in range(9)],
                                  "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path), file_bytes=300)
    found = warc.read_archives(spark, str(tmp_path))
    assert found.where("record_type = 'response' AND page_id = 8 AND url = 'http://a.b/c'"
                       ).collect()[0].payload == body
    reader = warc.WarcReader(str(tmp_path), 1)
    wanted, other = EqualTo(("record_type",), "revisit"), GreaterThan(("page_id",), 5)
    assert list(reader.pushFilters([wanted, other])) == [other] and reader.tests == [wanted]
    assert found.where("record_type = 'revisit'").count() == 4
    assert found.where("record_type = 'metadata'").count() == 2
    assert found.where("page_id > 5 AND record_type = 'response'").count() == 2
    names = [p.name for p in tmp_path.glob("*.warc.gz")]
    assert len(names) > 3 and not list(tmp_path.glob("_attempt*"))
    assert sorted(n for p in reader.partitions() for n in p.names) == sorted(names)


def test_digest_of_the_payload(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "é" * 60), (2, "u", "é" * 60)], "page_id long, url string, html string")
    digest = hashlib.sha256(("é" * 60).encode()).hexdigest()
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
            for r in warc.round_trip(pages, str(tmp_path / "w")).collect()} == {
        (1, 120, digest, "response", None), (2, 120, digest, "revisit", 1)}


def test_lists_as_of_the_fetch(spark):
    changes = spark.createDataFrame([
        ("a", "block", "domain", "Example.com", "add", "2024-01-10"),
        ("a", "block", "domain", "example.com", "remove", "2024-03-01"),
        ("a", "block", "domain", "example.com", "add", "2024-03-01"),
        ("a", "block", "domain", "example.com", "add", "2024-05-01"),
        ("b", "allow", "prefix", "www.example.com/News", "add", "2024-01-20"),
        ("c", "allow", "domain", "example.com", "add", "2024-05-02")],
        "list string, action string, kind string, pattern string, change string, dated string")
    captures = [(1, "2024-01-09"), (2, "2024-01-10"), (3, "2024-01-20"), (4, "2024-02-29"), (5, "2024-03-01"),
                (6, "2024-05-01"), (7, "2025-01-01")]
    found = url_filters.evaluate(spark.createDataFrame(
        [(i, "https://u:p@WWW.example.com:80/news/today?x=1", d) for i, d in captures]
        + [(10, "http://notexample.com/", "2024-02-01"), (11, "http://example.com/", "2024-06-01"),
           (12, "http://www.example.com/newspaper", "2024-02-01")],
        "page_id long, url string, fetched string"), changes)
    assert {r.page_id: (r.verdict, r.n_entries, r.lists) for r in found.collect()} == {
        1: ("none", 0, ""), 2: ("block", 1, "a"), 3: ("allow", 2, "a,b"), 4: ("allow", 2, "a,b"),
        5: ("allow", 1, "b"), 6: ("allow", 2, "a,b"), 7: ("allow", 3, "a,b,c"), 10: ("none", 0, ""),
        11: ("block", 2, "a,c"), 12: ("block", 1, "a")}
