"""From raw documents to sampled segmentations, in stages that are each written and read again.

Stages read and return the columns of documents; others are left out. Null and very long texts, repeated rows, ties and empty tables go
through every stage as its docstring and its operator's say. A stage's table is needed until the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm import exact_dedup, importance, mixing, near_dedup, pieces
from foliant.llm.shared import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps. Null and empty texts have weight 0 and are kept or not like others; rows of one id share
    their fate; without labels all are kept."""
    return importance.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id, one of rows equal in id and text. Null texts count as empty, so one of these stays."""
    return exact_dedup.dedup(docs).select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id. Texts without words have no set and stay."""
    return near_dedup.dedup(docs).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' target weights, shuffled; a document may come several times or not at all. A null source is one of its own.
    Rows with equal columns are the copies of one document."""
    return mixing.mix(docs).select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each copy's text, with copy_no: copies of a document are numbered again here, and each draws samples of its own,
    so that repetition adds segmentations. Texts without characters have one row without pieces."""
    copy = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id"))  # copies of one document only
    return pieces.sample(docs.withColumn("copy_no", copy), copy="copy_no")


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("sentencepiece", encoded)]
ORACLE_SQL = None  # no SQL for hashed n-gram models, similarity sketches or lattice sampling


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
