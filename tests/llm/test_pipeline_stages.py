"""The corpus pipeline on a small table, stage by stage."""

import corpus_pipeline
from gridcast.llm import decontaminate, langid
from tests.llm.test_text import brute_classes, brute_hits


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "sharding"]
    one = stages["language_id"](spark, docs, sf).cache()
    assert one.columns == columns and one.count() >= 0.98 * docs.count()
    two = stages["ngram_jaccard_join"](spark, one, sf).cache()
    rows = sorted((r["doc_id"], r["text"]) for r in one.collect())
    root = brute_classes(rows)
    assert sorted(r["doc_id"] for r in two.collect()) == [rows[r][0] for r in sorted(set(root))]
    three = stages["benchmark_decontamination"](spark, two, sf).cache()
    assert sorted(r["doc_id"] for r in three.collect()) == sorted(
        r["doc_id"] for r in two.collect() if not brute_hits(r["text"], items)[1])
    four = stages["source_mixing"](spark, three, sf).cache()
    assert four.columns == columns and max(r["count"] for r in four.groupBy("doc_id").count().collect()) <= 3
    five = stages["sharding"](spark, four, sf)
    assert five.columns == columns + ["shard", "slot"] and five.count() == four.count()


def test_stages_take_edge_documents(spark, edge_docs):
    sf = "/root/testdata/sf0.001"
    for docs in (edge_docs, edge_docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == edge_docs.columns
