"""Token counts of whole texts through a cache of digests.

The cache is a Parquet folder of (digest of the text, digest of the vocabulary,
number of tokens). A run joins its texts to it, encodes each distinct text that
is missing once, appends the counts, and joins them back to all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokenizer_files import byte_encoding, library, version_of

CACHE_SCHEMA = "digest BINARY, tokenizer STRING, n_tokens BIGINT"
LIMIT = 512


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _keyed(docs: DataFrame, column: str) -> DataFrame:
    text = F.coalesce(F.col(column), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    )


def _count(text: str, path: str) -> int:
    try:
        return len(byte_encoding(path).encode(text, allowed_special="all", disallowed_special=()))
    except ValueError:
        # The splitting pattern gives up on a million white-space characters in a row.
        return len(library(path).encode(text, add_special_tokens=False).ids)


def _encoder(path: str, version: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [_count(t, path) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("digest"),
                    pa.array([version] * batch.num_rows, pa.string()),
                    pa.array(counts, pa.int64()),
                ],
                ["digest", "tokenizer", "n_tokens"],
            )

    return encode


def cached_counts(spark: SparkSession, cache_dir: str, version: str) -> DataFrame:
    """Digest and count of all texts that the cache has for this vocabulary."""
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir)
    # Two jobs may have appended the same text; its count is the same.
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def add_missing(docs: DataFrame, cache_dir: str, path: str | None = None, column: str = "text") -> str:
    """Append the counts of texts that the cache lacks; gives the vocabulary's version.

    A text that several documents share is encoded once: copies are collapsed in
    the tasks that read them, before the shuffle, so that a text of many copies
    is one row from each.
    """
    spark = docs.sparkSession
    path = path or default_path()
    version = version_of(path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_dir)
    texts = _keyed(docs, column).select("digest", "text").dropDuplicates(["digest"])
    missing = texts.join(cached_counts(spark, cache_dir, version), "digest", "left_anti")
    missing.mapInArrow(_encoder(path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_dir)
    return version


def count_tokens(
    docs: DataFrame, cache_dir: str, path: str | None = None, column: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per document: bytes, tokens, and whether there are more than ``limit``.

    Special strings of the vocabulary count as one token, as the library does by
    default; none is added. A null text is an empty one (0 tokens). Repeated
    rows stay; other columns of ``docs`` are not read.
    """
    version = add_missing(docs, cache_dir, path, column)
    keyed = _keyed(docs, column).select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest"
    )
    counts = cached_counts(docs.sparkSession, cache_dir, version)
    return keyed.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
