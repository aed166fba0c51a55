"""The pipeline's stages against plain reckoning on the smallest tables, and on odd documents."""

import corpus_pipeline
from chronoframe.llm import language_id, packing, quality, queries
from pyspark.sql import functions as F

from .test_ops import check_packed, jaccard_brute, odd_documents

SF = "/root/testdata/sf0.001"


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = queries.table(spark, SF, "documents").cache()
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        kept[name] = out
        if name != "packing":
            assert out.columns == names
        if name in ("language_id", "quality"):
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(texts[r["doc_id"]] == r["text"] for r in out.collect())
        if name == "ngram_join":
            want = [c for i, n, c in jaccard_brute([(r["doc_id"], r["text"]) for r in docs.collect()])]
            assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(want))
        if name == "packing":
            used, least = check_packed(out.collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, queries.tokenizer_path("word_bpe_49k.json"))
            assert used <= least + 2
        docs = out
    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF, "labels").collect()}
    first = {r["doc_id"] for r in kept["language_id"].collect()}
    stay = {r["doc_id"] for r in kept["quality"].collect()}
    good = [i for i in first if labels.get(i) == 1]
    assert len([i for i in good if i in stay]) >= 0.95 * len(good)
    total = queries.table(spark, SF, "documents").count()
    assert len(first) >= 0.97 * total


def test_stages_take_odd_documents(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "packing" or out.columns == docs.columns
        out.collect()


def test_run_returns_the_packed_sequences(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
