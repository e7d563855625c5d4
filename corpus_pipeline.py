"""From raw documents to a training mix: quality, near-duplicates, benchmark leaks, personal data, weights.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept. All but
the last return the columns of ``docs``; the mix adds ``mix_copy`` and ``mix_words`` and holds a row
for each repetition of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import mixing, near_copies, pii, qgram_leaks, quality_mcd
from matchlake.llm.common import table
from matchlake.session import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are outliers of their language and source."""
    return quality_mcd.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, by five-word shingles."""
    return near_copies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return qgram_leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample documents so that sources reach their weights."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("mixture", mixture),
]

#: No SQL: estimates by concentration steps, metric trees and alignment; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
