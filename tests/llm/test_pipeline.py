"""The pipeline against plain-Python stages, on small whole tables and on odd rows."""

import corpus_pipeline
import pytest
from candlestream.llm import pii, quality
from tests.llm import brute, data

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = rows(docs)
        after, _ = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name)
        if name == "best_fit_packing":
            assert {r.doc_id for r in after.collect()} == {d for d, _ in before}
            break
        assert after.columns == docs.columns
        got = {d for d, _ in rows(after)}
        if name == "quality_rules":
            assert got == {r.doc_id for r in quality.cascade(docs).collect() if r.failed_rule is None}
        elif name == "near_duplicates":
            assert got == {c for _, c, _ in brute.classes(before)}
        elif name == "benchmark_decontamination":
            assert got == {d for d, _ in before} - {d for d, _, _ in brute.leaks(before, items)}
        else:
            assert [d for d, t in rows(after) if list(pii.mentions(t)) and t in dict(before).values()] == []
        docs = after


@pytest.mark.parametrize("limit", [corpus_pipeline.BROADCAST_KEYS, -1])
def test_stages_on_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_KEYS", limit)
    docs = data.frame(spark)
    first = docs
    for name, stage in corpus_pipeline.STAGES:
        docs, _ = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name)
        if name == "near_duplicates":
            kept = rows(docs)
            assert len(kept) == len({t for _, t in kept}) and {5, 9, 14} <= {d for d, _ in kept}
            assert not {6, 8} & {d for d, _ in kept}
        if name != "best_fit_packing":
            assert docs.columns == first.columns


def test_no_documents(spark):
    docs = data.frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs, n = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name)
        assert n == 0
