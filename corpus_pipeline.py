"""A corpus pipeline over ``documents``: filter, dedup, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its
result is written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_align, mixing, quality, simhash
from tidemark.llm.common import crc_rest, table
from tidemark.llm.queries import QUALITY_FROM
from tidemark.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; the model is learnt from ``docs``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality",
                          crc_rest(F.col("__id"), 5) != 0)
    return quality.accepted(docs, model, QUALITY_FROM)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line blocks they share with earlier ones."""
    return line_align.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document: doc_id, size, source, source_size,
    target, taken."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
]

# Hashing, learning and alignment have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"corpus-stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
