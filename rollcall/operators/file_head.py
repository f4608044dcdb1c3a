"""The first n rows of every input file, in file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import own_session

ORIGIN = ["_file", "_block"]
# The bits of a row's number that count within its task.
IN_TASK = (1 << 33) - 1


def one_block_a_task(spark: SparkSession) -> SparkSession:
    """A session of its own whose scans give each task one block (split of a file).

    A place counted along a task is then a place in a block, so blocks are cut
    by a plain filter. Opening a file is said to cost as much as reading a full
    block, so no task is given two.
    """
    own = own_session(spark)
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.unset("spark.sql.files.maxPartitionNum")
    return own


def with_origin(scan: DataFrame) -> DataFrame:
    """Add the file and the block (split start) each row was read from."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def blocks_of(rows: DataFrame) -> int:
    """The number of blocks that a scan of :func:`one_block_a_task` reads."""
    return rows._jdf.queryExecution().toRdd().getNumPartitions()


def with_position(rows: DataFrame) -> DataFrame:
    """Add a number that grows along each block; use it right after the scan."""
    return rows.withColumn("_pos", F.monotonically_increasing_id())


def block_heads(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each block, numbered; all that a cap can keep.

    ``rows`` come with their position from a scan of :func:`one_block_a_task`. Each block is
    cut in the task that reads it, row by row: nothing is sorted or shuffled.
    """
    return rows.selectExpr("* EXCEPT (_pos)", f"(_pos & {IN_TASK}) + 1 AS _row").filter(f"_row <= {n}")


def blocks_before(heads: DataFrame, n: int, *measures: Column) -> DataFrame:
    """One row per block that the cap reaches: what the blocks before it have, and its measures."""
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        heads.groupBy(*ORIGIN)
        .agg(F.count("*").alias("_rows"), *measures)
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .filter(F.col("_before") < n)
        .drop("_rows")
    )


def cap_blocks(heads: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """From block heads and their :func:`blocks_before`, the first ``n`` rows of each file."""
    in_file = F.col("_row") + F.col("_before")
    return heads.join(blocks, ORIGIN).filter(in_file <= n).withColumn("_row", in_file).drop("_before")


def gathered_files(heads: DataFrame, n: int) -> DataFrame:
    """From block heads, the first ``n`` rows of each file; ``_good`` is false for all
    rows of a file when one of them is not ``_ok``.

    Heads are read once, and all of a file's meet in one task: for few rows. More are
    capped by :func:`blocks_before` and :func:`cap_blocks`.
    """
    in_file = heads.selectExpr(
        "* EXCEPT (_row)", "CAST(row_number() OVER (PARTITION BY _file ORDER BY _block, _row) AS BIGINT) AS _row"
    )
    first_bad = "min(CASE WHEN NOT _ok THEN _row END) OVER (PARTITION BY _file)"
    return in_file.selectExpr("*", f"coalesce({first_bad} > {n}, true) AS _good").filter(f"_row <= {n}")


def cap_files(heads: DataFrame, n: int) -> DataFrame:
    """From block heads, the first ``n`` rows of each file, in file order.

    A block keeps what the blocks before it have left over. So a file of any
    size is never gathered in one task: only one row per block is. ``heads`` is
    used twice; pass written rows rather than a scan.
    """
    return cap_blocks(heads, blocks_before(heads, n), n)
