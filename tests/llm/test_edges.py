"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import random

import pytest

import corpus_pipeline
from eventmart.llm import (
    decontamination, jaccard_join, language_id, packing, pii, quality_model, quality_rules, queries,
    toxicity, url_filters, warc)
from eventmart.llm.common import staged

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, `Text` string"
LONG = "word " * 30_000
ROWS = [
    (1, None, None, None, None, None, "x"), (2, "", "en", "s", 0, 0.5, "x"),
    (3, " \n\t ", "en", "s", 3, 0.5, "x"), (4, "12 34 !!", "en", "s", 8, None, None),
    (5, LONG, "de", "s", len(LONG), 0.5, "x"), (6, "the cat sat on the mat again", "en", "s", 28, 0.1, "x"),
    (6, "the cat sat on the mat again", "en", "s", 28, 0.1, "x"),
    (7, "the cat sat on the mat again", "en", "s", 28, 0.1, "x"),
    (None, "a row without any id at all", "en", "s", 27, 0.1, "x")]
LABELS = [(1, 0, 0), (2, 1, None), (3, None, 1), (5, 0, 0), (6, 1, 1), (7, 1, 0), (None, 1, 1)]
BENCHMARK = [(1, "the cat sat"), (2, None), (3, ""), (None, "on the mat")]


@pytest.fixture(scope="module")
def operators(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    return {
        "quality_rules": quality_rules.compression_verdicts,
        "quality_model": lambda d: quality_model.score(d, labels),
        "toxicity": lambda d: toxicity.score(d, labels),
        "language_id": language_id.identify,
        "pii": pii.personal_spans,
        "decontamination": lambda d: decontamination.decontaminate(d, items),
        "jaccard_join": jaccard_join.similar_documents,
        "packing": lambda d: packing.pack(d, queries.TOKENIZER, queries.PATTERN),
    }


NAMES = ("quality_rules", "quality_model", "toxicity", "language_id", "pii", "decontamination",
         "jaccard_join", "packing")


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_its_result(spark, operators, name):
    found = operators[name](spark.createDataFrame(ROWS, DOCS)).collect()
    ids = [r.doc_id for r in found if name != "packing" or r.piece == 0]
    assert sorted(ids, key=str) == sorted((r[0] for r in ROWS), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, operators, name):
    assert operators[name](spark.createDataFrame([], DOCS)).collect() == []


def test_defined_results(spark, operators):
    docs = spark.createDataFrame(ROWS, DOCS)
    rules = {r.doc_id: r for r in operators["quality_rules"](docs).collect()}
    assert not any(rules[i].kept for i in (1, 2, 3, 4, 5)) and rules[5].n_repeat_words == 30_000
    languages = {r.doc_id: r for r in operators["language_id"](docs).collect()}
    assert [languages[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4
    assert all(languages[i].score == 0 for i in (1, 2, 3, 4))
    toxic = {r.doc_id: r.score for r in operators["toxicity"](docs).collect()}
    assert toxic[1] == toxic[2] == toxic[3] == 0
    clean = {r.doc_id: r for r in operators["decontamination"](docs).collect()}
    assert clean[1].n_words == 0 and not clean[1].contaminated
    assert (clean[7].n_hit, clean[7].items, clean[7].contaminated) == (3, ["1"], True)
    groups = {r.doc_id: r for r in operators["jaccard_join"](docs).collect()}
    assert [groups[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, None)] == [1, 2, 3, 4, 5, 6, 6, None]
    assert (groups[1].n_shingles, groups[4].n_shingles, groups[5].n_shingles) == (0, 1, 1)
    pieces = operators["packing"](docs).collect()
    assert {r.length for r in pieces if r.doc_id in (1, 2)} == {1}
    assert sum(r.length for r in pieces if r.doc_id == 5) > 30_000


STAGE_NAMES = ["doc_id", "text", "lang", "source", "n_chars", "DOC_ID", "Text", "text", "component_id", "c0"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def stage_docs(spark, rows):
    """Documents with further columns whose names clash, one of them by another case and one twice."""
    return spark.createDataFrame([(*r[:5], -1, "T", "second", 7, "z") for r in rows], (
        "a long, b string, c string, d string, e long, f long, g string, h string, i long, j string")).toDF(*STAGE_NAMES)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns(spark, sf_dir, stage):
    name, run = stage
    draw = random.Random(1)
    good = " ".join("".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(2, 9))) for _ in range(120))
    rows = [*ROWS, (8, good + " a@b.cd", "en", "s", 1), (8, good + " a@b.cd", "en", "s", 1),
            (9, good + " a@b.cd x", "en", "s", 1), (None, good, None, None, None)]
    docs = staged(stage_docs(spark, rows), "clashing")
    assert docs.columns == STAGE_NAMES
    found = run(spark, docs, sf_dir)
    if name == "packing":
        assert {r.doc_id for r in found.collect()} == {r[0] for r in rows}
        assert run(spark, stage_docs(spark, []), sf_dir).collect() == []
        return
    assert found.columns == STAGE_NAMES
    left = [tuple(r) for r in staged(found, "kept").collect()]
    wanted = {"quality_rules": [8, 8, 9, None], "jaccard_join": [1, 2, 3, 4, 5, 6, 6, 8, 8, None, None],
              "decontamination": [1, 2, 3, 4, 5, 8, 8, 9, None, None],
              "personal_data": [1, 2, 3, 4, 5, 6, 6, 7, 8, 8, 9, None, None]}[name]
    assert sorted((r[0] for r in left), key=str) == sorted(wanted, key=str)
    assert {r[5:] for r in left} == {(-1, "T", "second", 7, "z")}
    texts = {r[0]: r[1] for r in left if r[0]}
    assert texts[8] == good + (" <EMAIL>" if name == "personal_data" else " a@b.cd")
    empty = staged(run(spark, stage_docs(spark, []), sf_dir), "none")
    assert empty.columns == STAGE_NAMES and empty.collect() == []


def test_no_labels_and_no_benchmark(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert {r.score for r in quality_model.score(docs, labels).collect()} == {0.5}
    assert {r.score for r in toxicity.score(docs, labels).collect()} == {0.0}
    assert {r.n_hit for r in decontamination.decontaminate(docs, items).collect()} == {0}


PAGES = "page_id long, url string, html string, payload string, record_type string"


def test_pages(spark, tmp_path):
    same = "x" * 100
    rows = [(3, "http://a.b/\r\nX: y", same, "p", "q"), (2, None, same, None, None), (9, "u", same, "p", "q"),
            (4, "http://c.d", None, "p", "q"), (5, "http://c.d", "", "p", "q"), (6, "e", "x" * 99, "p", "q"),
            (7, "e", "x" * 99, "p", "q"), (None, "n", "é" * 50, "p", "q")]
    found = {r.page_id: r for r in warc.round_trip(
        spark.createDataFrame(rows, PAGES), str(tmp_path / "a")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in found.items()} == {
        2: ("response", None), 3: ("revisit", 2), 9: ("revisit", 2), 4: ("response", None),
        5: ("response", None), 6: ("response", None), 7: ("response", None), None: ("response", None)}
    assert [found[i].payload_bytes for i in (2, 3, 4, None)] == [100, 100, 0, 100]
    assert found[3].payload_digest == found[2].payload_digest
    assert warc.round_trip(spark.createDataFrame([], PAGES), str(tmp_path / "b")).collect() == []


def test_captures(spark):
    captures = spark.createDataFrame(
        [(1, None, None), (2, "", "2024-01-05"), (3, "/relative", "2024-01-05"),
         (4, "http://a.b/c", None), (None, "http://A.b./c", "2024-01-05"),
         (None, "http://A.b./c", "2024-01-05")],
        "page_id long, url string, fetched string").selectExpr("*", "'x' AS day", "1 AS n")
    changes = spark.createDataFrame(
        [("l", "block", "domain", "b", "add", "2024-01-01"), (None, "block", None, "b", "add", None)],
        "list string, action string, kind string, pattern string, change string, dated string")
    found = url_filters.evaluate(captures, changes).collect()
    assert sorted((str(r.page_id), r.verdict, r.host) for r in found) == [
        ("1", "none", ""), ("2", "none", ""), ("3", "none", ""), ("4", "none", "a.b"),
        ("None", "block", "a.b"), ("None", "block", "a.b")]
    assert {r.verdict for r in url_filters.evaluate(captures, changes.limit(0)).collect()} == {"none"}
    assert url_filters.evaluate(captures.limit(0), changes).collect() == []
