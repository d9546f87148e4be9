"""A training-corpus pipeline of five stages, each one operator of ``marisight.llm`` over all it is given.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  Between stages the rows are written as Parquet and read again, so no stage's lineage
reaches into the one before.

Defined results: empty tables stay empty; null and empty texts are judged by the classifier like others,
are no near duplicates, lose nothing and have no words to mix; rows with a null id are never near
duplicates of others that go; rows that share an id are one document to the near-duplicate stage and
separate ones to the mix; further columns, whatever their names, pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marisight.llm import jaccard_join, quality_fm, sentencepiece_codec, source_mixing, substring_dedup
from marisight.llm._shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on this corpus's labels, rejects go."""
    model = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.score(docs, model, prefix="__").where(F.col("__predicted") == 1).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 0.8 of their five-word shingles the one with the smallest id stays."""
    classes = jaccard_join.near_duplicates(docs, shingle=5, percent=80)
    gone = classes.where(F.col("doc_id") != F.coalesce("component_id", F.col("doc_id") - 1)).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; texts without any stay as they are."""
    out = substring_dedup.remove_repeats(docs, prefix="__")
    whole = F.col("__n_removed") == 0
    cut = out.withColumn("text", F.when(whole, F.col("text")).otherwise(F.col("__kept_text"))).withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("__kept_text").cast("long")))
    return cut.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words; where it takes part of a document, the row holds
    the blocks that were drawn, so that each source's words come to its target."""
    out = source_mixing.mixed_texts(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text as digest and length, with what they decode to."""
    rows = sentencepiece_codec.encode_and_decode(docs.select("doc_id", "text", "source"))
    return sentencepiece_codec.digests(rows)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL can't express a fitted model or a tokenizer; tests compare each stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
