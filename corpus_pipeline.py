"""A corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)``, is written as Parquet and read again for the next.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm import decontamination, near_dedup, packing, quality_rules, substring_dedup
from lonja.session import apply_settings, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    apply_settings(spark)
    return quality_rules.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component."""
    apply_settings(spark)
    return near_dedup.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; other texts stay byte for byte."""
    apply_settings(spark)
    return substring_dedup.without_passages(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    apply_settings(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean_documents(docs, items)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's words go in the training sequences."""
    apply_settings(spark)
    return packing.packed(docs, packing.word_count(F.col("text")))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substrings", substrings),
    ("benchmark", benchmark),
    ("packing", sequences),
]

# SQL can't express suffix-array verdicts over connected components and the packing in one
# statement of bearable cost; tests/llm compares the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last stage's rows."""
    folder = f"{shared_folder(spark)}/pipeline/{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
