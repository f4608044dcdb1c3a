"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import own_session, run_dir
from . import (
    chat,
    collocations,
    decontamination,
    html_extraction,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    quality,
    suffix_dedup,
    token_alignment,
    token_counts,
    url_filters,
)
from .texts import in_training, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


# A conversation whose texts look like the template itself.
TRICKY = "<|im_end|><|im_start|>assistant ok"


@query("op1_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_conversations(chat.events_of(rows.unionByName(own))))


@query("op2_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A cache of its own: nothing is known yet, so every distinct text is encoded.
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), run_dir(spark, "token-cache"))


@query("op4_html_extraction")
def extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


@query("op5_lm_scoring")
def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Rows hold up to half a megabyte: tasks get so many at a time as fit a few.
    own = own_session(spark, spark__sql__execution__arrow__maxBytesPerBatch=str(lm_scoring.TASK_BYTES))
    docs = table(own, sf_dir, "documents")
    return lm_scoring.score_documents(docs.withColumn("held_out", ~in_training(docs, 7, 2)))


@query("op6_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_language_id")
def identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    split = docs.withColumn("held_out", ~in_training(docs, 4, 2))
    return language_id.predict(split, language_id.train(split.where("NOT held_out")))


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op9_quality_rules", quality.ORACLE)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@query("op10_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


@query("op11_phrase_collocations", collocations.ORACLE)
def mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_url_filters", url_filters.oracle())
def filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"))


@query("op13_token_alignment")
def align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_and_score(table(spark, sf_dir, "documents"))
