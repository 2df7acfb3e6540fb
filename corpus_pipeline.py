"""The corpus pipeline: five stages from raw documents to packed training sequences."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from patchloom.llm import decontaminate, lines, neardup, packing, quality
from patchloom.llm.common import prepared, shared_folder, table

NEAR_PERCENT = 80  # documents at least so much alike are near-duplicates
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Classifying, edit distance and packing are not to be said in SQL.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the given documents alone."""
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of like lines stays; documents without any line left go."""
    return lines.clean_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, 80 % alike or more, stays."""
    return neardup.drop_near_duplicates(docs, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 4,096 tokens."""
    return packing.pack_best_two_fit(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", dedupe_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written to the shared folder and read again."""
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
