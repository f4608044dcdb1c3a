"""Left join of a fact table with a lookup table of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def are_small(
    *dims: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """Measure lookup tables in one job: may every executor hold a copy of each?"""

    def size(number: int, dim: DataFrame) -> DataFrame:
        width = F.lit(0)
        for field in dim.schema:
            text = isinstance(field.dataType, T.StringType)
            length = F.octet_length(field.name) if text else F.lit(8)
            width += F.coalesce(length, F.lit(0))
        total = F.coalesce(F.sum(width.cast("bigint")), F.lit(0))
        return dim.agg(F.lit(number), F.count("*"), total)

    sizes = reduce(DataFrame.unionAll, [size(i, dim) for i, dim in enumerate(dims)])
    return [rows <= max_rows and width <= max_bytes for _, rows, width in sorted(sizes.collect())]


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, *, small: bool) -> DataFrame:
    """All rows of ``fact`` with the matching columns of ``dim``, nulls if none.

    A repeated key in ``dim`` repeats the fact row. ``small`` is what
    ``are_small`` found: a small lookup table is broadcast. A larger one is
    joined by shuffle. Rows without a key match nothing, so they are spread over
    all tasks; other hot keys are left to adaptive execution, which splits the
    partitions they make too large. The facts are read once.
    """
    dim = dim.withColumnRenamed(dim_key, "_key")
    if small:
        return fact.join(F.broadcast(dim), F.col(fact_key) == F.col("_key"), "left").drop("_key")
    # Row content plus input partition: the same after a task is run again, and
    # equal rows of different partitions still spread.
    spread = F.xxhash64(F.spark_partition_id(), *fact.columns)
    placed = fact.withColumn("_place", F.when(F.col(fact_key).isNull(), spread).otherwise(0))
    return placed.join(
        dim.withColumn("_dim_place", F.lit(0).cast("bigint")),
        (F.col(fact_key) == F.col("_key")) & (F.col("_place") == F.col("_dim_place")),
        "left",
    ).drop("_key", "_place", "_dim_place")
