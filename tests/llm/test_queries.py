"""The registered queries on the smallest tables, and the pipeline's stages."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from eventmart.llm import decontamination, jaccard_join
from eventmart.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    wanted = duck.sql(SQL[name])
    columns = sorted(wanted.columns)
    order = [wanted.columns.index(c) for c in columns]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == columns
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(
        str(tuple(r[i] for i in order)) for r in wanted.fetchall())


@needs_data
def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns, name
    after = kept.collect()
    assert 0 < len(after) < len(before)
    groups = {r.component_id for r in jaccard_join.similar_documents(
        docs.where(docs.doc_id.isin([r.doc_id for r in after]))).collect()}
    assert len(groups) == len(after)
    assert not decontamination.decontaminate(docs.where(docs.doc_id.isin(
        [r.doc_id for r in after])), benchmark).where("contaminated").count()
    assert {d for d, t in before.items() if "@mail" in t} & {r.doc_id for r in after if "@mail" in r.text} == set()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in after}
