"""A cleaning and packing pipeline over ``documents``, each stage one operator.

Defined results: a null or empty text has no language and goes in the first stage. Documents of the same id are judged by
their own texts. Of lines and documents that repeat, one stays, that of the least doc_id; a document whose lines all go,
goes. An empty table gives an empty table. Extra columns are carried to the last stage; packing returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm import language_id, line_dedup, ngram_join, packing, quality
from chronoframe.llm.queries import table, tokenizer_path
from chronoframe.llm.shared import Scratch

#: A document whose language is not recognised at all, or with less than this probability, is rejected.
LANGUAGE_SCORE = 0.5
#: Documents that score less are rejected. Lower than the operator's own 0.7, so that clean documents stay; the README has both.
QUALITY_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned; ``lang`` becomes the language found."""
    model = language_id.train(docs, language_id.learnable(F.col("doc_id"), 3, 1))
    told = language_id.classify(docs, model, out=("__lang", "__score"))
    found, score = told.columns[-2:]
    kept = told.where((F.col(found) != "und") & (F.col(score) >= LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col(found)).select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose quality score reaches the threshold."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), language_id.learnable(F.col("doc_id"), 4, 2))
    told = quality.score(docs, model, out=("__score", "__predicted"))
    return told.where(F.col(told.columns[-2]) >= QUALITY_SCORE).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of similar lines; documents of which no line stays go."""
    out = line_dedup.dedup_lines(docs)
    lines, kept = (F.col(c) for c in out.columns[-2:])
    return out.where((lines == 0) | (kept > 0)).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    return ngram_join.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: a row per piece with its place."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language_id", language_stage), ("quality", quality_stage), ("line_dedup", line_stage), ("ngram_join", ngram_stage), ("packing", packing_stage)]

#: Trained models, fuzzy joins and tokenisers have no SQL; tests/llm hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written to the shared folder and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = scratch.write(out, name) if k < len(STAGES) - 1 else out
    return docs
