"""Corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet in the
shared checkpoint folder and reads it again for the next.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulestream.llm import jaccard, linededup, mil, packing, semicrf
from rulestream.llm.catalog import tokenizer_path
from rulestream.llm.common import checkpoint_ready, crc32_mod, importable, read_table


def _as_documents(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with n_chars counted anew."""
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select(like.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose text scores under 0.7; learns from the folds that are not held out."""
    importable(spark)
    return mil.filter_quality(docs, mil.train(docs, read_table(spark, sf_dir, "labels"), crc32_mod(F.col("doc_id"), 4) != 2))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes aligned common blocks from later documents; a document that loses its whole text goes."""
    importable(spark)
    done = linededup.dedup_lines(docs)
    return _as_documents(done.where((F.col("lines_deleted") == 0) | F.col("text").rlike(r"\S")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of similar documents; texts decide, also among rows of one id."""
    importable(spark)
    return jaccard.keep_one(docs).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    importable(spark)
    return _as_documents(semicrf.redact(docs, semicrf.learn(docs)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    importable(spark)
    return packing.pack_documents(docs, tokenizer_path(), hold_encoder=False)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", pack)]

ORACLE_SQL = None  # learned models, alignment and packing are beyond SQL; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_ready(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/corpus_pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}_{name}")
        docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs
