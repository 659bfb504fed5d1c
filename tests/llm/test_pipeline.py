"""The pipeline stage by stage, and the queries that have checking SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checking import assert_same, connect
from pingzones.llm import catalog, mixing, simhash


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert assert_same(catalog.QUERIES[name](spark, sf), connect(sf), catalog.ORACLES[name]) > 0


def test_stages(spark, sf):
    docs = catalog.table(spark, sf, "documents")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, sf), "test-stage")
        assert docs.schema == before.schema, name
        assert docs.exceptAll(before).count() == 0 or name.startswith("mixing"), name
        sizes.append(docs.count())
        if name == "SimHash near-dedup":
            groups = simhash.near_duplicates(before)
            assert docs.count() == groups.select("component_id").distinct().count()
            assert docs.join(groups, "doc_id").filter("doc_id <> component_id").count() == 0
        if name == "benchmark decontamination":
            hit = before.join(catalog.op4_benchmark_index(spark, sf).filter("contaminated"), "doc_id")
            assert docs.count() == before.count() - hit.count() and docs.join(hit, "doc_id").count() == 0
        if name.startswith("mixing"):
            taken = mixing.mix(before).filter("copies > 0").select("doc_id", "copies")
            repeated = docs.groupBy("doc_id").agg(F.count("*").alias("copies"))
            assert repeated.exceptAll(taken).count() == 0 and taken.exceptAll(repeated).count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() == sizes[-1] and out.select("shard", "slot").distinct().count() == sizes[-1]


def test_run_equals_the_stages(spark, tiny):
    docs = catalog.table(spark, tiny, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, tiny).collect()))
