"""The corpus pipeline: each stage works on the documents its predecessor kept.

Every row is decided on by itself: where ``doc_id`` is null or repeated, a stage numbers
the rows in the order of ids, null ids last, and works with the numbers.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import numbered, stage, tuned
from tideline.llm.decontaminate import contaminated
from tideline.llm.exact_dedup import exact_dedup
from tideline.llm.jaccard import jaccard_classes
from tideline.llm.packing import pack
from tideline.llm.quality import quality_of, training_labels

REJECT_BELOW = 0.5  # score of a document that goes
ROW = "_row"  # what tells rows apart within a stage


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` and a key of each row: ``doc_id`` if it is one, a number in its order otherwise."""
    row = F.col("doc_id").cast("long")
    shared = docs.groupBy(row.alias("id")).count().where("id IS NULL OR count > 1")
    return docs.withColumn(ROW, row) if shared.isEmpty() else numbered(docs, ROW)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled documents."""
    labels = training_labels(tuned(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_of(docs, labels)(F.coalesce("text", F.lit(""))) >= REJECT_BELOW)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    tuned(spark)
    rows = with_row(docs)
    kept = exact_dedup(rows, ROW).where("kept").select(F.col("id").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked texts the one with the smallest id stays."""
    tuned(spark)
    rows = with_row(docs)
    stays = jaccard_classes(rows, id_col=ROW).where("component_id = id").select(F.col("id").alias(ROW))
    return rows.join(stays, ROW, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a test item go."""
    items = tuned(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = with_row(docs)
    bad = contaminated(rows, items, ROW).select(F.col("id").alias(ROW)).distinct()
    return rows.join(bad, ROW, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    tuned(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]
#: Scores, edit distances and packings are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
