"""From raw documents to packed sequences: quality, near copies, repeats, leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; the caller writes it
and reads it again as the next stage's documents. All but the last return the
columns of ``documents``.

A null text is an empty one and fails the quality rules. A null doc_id is kept
by the filters and packed like any other. Repeated rows are one document from
the near-copy stage on. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import decontamination, near_dedup, packing, quality, suffix_dedup
from rollcall.llm.texts import ship_code, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality.filter_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one of least doc_id."""
    ship_code(spark)
    return near_dedup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that another one has already."""
    ship_code(spark)
    return suffix_dedup.remove_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place there."""
    ship_code(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each gives is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Near copies and edit distances have no SQL; the tests hold each stage against
# a brute-force version.
ORACLE_SQL = None
