import importlib

import pytest

import corpus_pipeline
from laserfold.llm import jaccard_join, quality_gam, quality_rules
from laserfold.llm.queries import registry
from tests.conftest import SMALL
from tests.llm.data import documents

DOC_STAGES = corpus_pipeline.STAGES[:-1]


@pytest.mark.parametrize("name", [s[0] for s in DOC_STAGES])
def test_stages_return_the_columns_of_their_input(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for clashing in (False, True):
        docs = documents(spark, clashing=clashing)
        kept = stage(spark, docs, SMALL)
        assert sorted(kept.columns) == sorted(c for c in docs.columns if c != "epoch" or name != "mixing")
        before = {str(r.asDict()) for r in docs.select("doc_id", "text", "lang").collect()}
        rows = [str(r.asDict()) for r in kept.select("doc_id", "text", "lang").collect()]
        assert set(rows) <= before
    assert stage(spark, documents(spark, [], clashing=False), SMALL).count() == 0


def test_pipeline_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    # The same decisions, each taken by its own operator on what the one before kept.
    model = quality_gam.train(docs, labels)
    good = {r.doc_id for r in quality_gam.score(docs, model).where("predicted = 1").collect()}
    first = docs.where(docs.doc_id.isin(good))
    trusted = labels.where("quality = 1").select("doc_id")
    ruled = {r.doc_id for r in quality_rules.judge(first, trusted).where("kept").collect()}
    second = first.where(first.doc_id.isin(ruled))
    alone = {r.doc_id for r in jaccard_join.join(second).where("kept").collect()}
    packed = {p.doc_id for p in pieces}
    assert packed <= alone <= ruled <= good
    assert packed == alone
    sizes = {p.doc_id: p.doc_tokens for p in pieces}
    lengths = {}
    for p in pieces:
        lengths[p.doc_id] = lengths.get(p.doc_id, 0) + p.length
    # Mixing takes every document once and those of scarce sources up to twice.
    epochs = {d: n / sizes[d] for d, n in lengths.items()}
    assert set(epochs.values()) == {1.0, 2.0}


def test_entry_lists_the_queries():
    book = importlib.import_module("__spark_entry__")
    names = set(book.queries())
    assert set(registry) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in registry} == {f"op{i}" for i in range(1, 14)}
