"""Landed batches: capped CSV files and validated JSON records, appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.file_head import (
    ORIGIN,
    block_heads,
    blocks_before,
    cap_blocks,
    one_block_a_task,
    with_position,
)
from ..operators.typed import typed_lines, typed_records
from ..schemas import TABLES, table_schema
from ..session import written
from ..sources import csv, files, records, tables
from .history import NO_SCHEMA
from .status import (
    APPEND_REPORT,
    SKIPPED,
    append_result,
    attempt_append,
    for_each_table,
    report,
)

# Fixed value: rows taken from one CSV file.
MAX_ROWS = 1000


def line_heads(lines: DataFrame, schema: T.StructType, max_rows: int = MAX_ROWS) -> DataFrame:
    """Typed CSV lines, as many of each block as the cap could keep.

    Lines are cut before they are parsed: most of a long file is only read over.
    They come from a scan of :func:`one_block_a_task`.
    """
    heads = block_heads(with_position(lines), max_rows)
    return typed_lines(csv.parse_lines(heads, schema), schema)


def whole_lines(heads: DataFrame, any_bad: bool) -> DataFrame:
    """What :func:`capped_lines` gives if every file is one block: its head is what the cap keeps."""
    heads = heads.select(*ORIGIN, *[c for c in heads.columns if c not in ORIGIN])
    if not any_bad:
        return heads.withColumn("_good", F.lit(True))
    bad = heads.filter("NOT _ok").select(F.col("_file").alias("_bad")).distinct()
    joined = heads.join(bad, F.col("_file") == F.col("_bad"), "left")
    return joined.withColumn("_good", F.col("_bad").isNull()).drop("_bad")


def capped_lines(heads: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The first rows of each file; ``_good`` is false for all rows of a file
    when one of them does not fit the table.

    A file's first such row is found with its blocks: heads are joined once.
    """
    first_bad = F.min(F.when(~F.col("_ok"), F.col("_row"))).alias("_bad")
    of_file = F.min(F.col("_bad") + F.col("_before")).over(Window.partitionBy("_file"))
    good = F.coalesce(of_file > max_rows, F.lit(True))
    blocks = blocks_before(heads, max_rows, first_bad).withColumn("_good", good).drop("_bad")
    return cap_blocks(heads, blocks, max_rows)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Every record as the table's columns and as it came, with ``_ok``."""
    return typed_records(records.parse_records(rows, schema), schema)


def checked_records(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`typed` with the place of each record in its file; use it right after the scan."""
    return typed(with_position(rows), schema)


def bounded_records(checked: DataFrame, max_rows: int) -> DataFrame:
    """Of written checked records, the first accepted ones of each file."""
    in_file = Window.partitionBy("_file").orderBy("_block", "_pos")
    accepted = checked.filter("_ok").withColumn("_row", F.row_number().over(in_file))
    return accepted.filter(F.col("_row") <= max_rows).drop("_row")


def refused_records(checked: DataFrame) -> DataFrame:
    """Every record that is no valid row of the table, as it came and with its file."""
    return checked.filter("NOT _ok").drop("_ok", "_block", "_pos")


def append_capped_csv(
    spark: SparkSession,
    src_dir: str,
    db: str,
    max_rows: int = MAX_ROWS,
    rejects_dir: str | None = None,
) -> DataFrame:
    """Append the first ``max_rows`` rows of each landed file to its table.

    A file with a row that does not fit adds nothing; with ``rejects_dir`` its
    rows are kept there per table. Running it again appends again. The report
    counts the rows appended.
    """
    found = files.tables_in(spark, src_dir, ".csv")

    def one(table: str) -> list[dict]:
        if table not in TABLES:
            nothing = dict(rows=None, rows_refused=None, rows_left_out=None)
            return [dict(table=table, status=SKIPPED, message=NO_SCHEMA, **nothing)]
        schema = table_schema(table)

        def step():
            seen = Observation()
            lines = csv.read_lines(one_block_a_task(spark), found[table]).observe(seen, F.count("*").alias("lines"))
            with written(line_heads(lines, schema, max_rows), "lines", spark) as heads:
                capped = capped_lines(heads, max_rows)
                # A good file adds all its rows, a bad one none.
                rows, refused, bad_files = capped.agg(
                    F.count_if("_good"),
                    F.count_if(~F.col("_good")),
                    F.count_distinct(F.when(~F.col("_good"), F.col("_file"))),
                ).first()
                # Rejects first: if they cannot be kept, nothing has been appended.
                if rejects_dir:
                    bad = capped.filter("NOT _good").drop("_block", "_row", "_good")
                    bad.write.mode("append").parquet(f"{rejects_dir.rstrip('/')}/{table}")
                left_out = seen.get["lines"] - rows - refused
                tables.append_table(capped.filter("_good").select(schema.names), db, table)
            return append_result(rows, refused, left_out, f"files rejected: {bad_files}")

        return [attempt_append(table, step)]

    return report(spark, for_each_table(spark, found, one), APPEND_REPORT)


def append_records(
    spark: SparkSession,
    json_dir: str,
    db: str,
    table: str,
    max_rows: int | None = None,
    rejects_dir: str | None = None,
) -> DataFrame:
    """Append the valid JSON records of a folder to a table, by column name.

    Rejected records go to ``rejects_dir`` if it is given. ``max_rows``, if
    given, bounds the records taken from one file. The report counts the rows
    appended, those refused, and those beyond the bound.
    """
    schema = table_schema(table)

    def step():
        seen = Observation()
        rows = checked_records(records.read_records(spark, json_dir), schema)
        rows = rows.observe(seen, F.count_if("_ok").alias("valid"), F.count_if(~F.col("_ok")).alias("refused"))
        with written(rows, "records") as checked:
            valid, refused = seen.get["valid"], seen.get["refused"]
            taken = checked.filter("_ok") if max_rows is None else bounded_records(checked, max_rows)
            count = valid if max_rows is None else taken.count()
            # Rejects first: if they cannot be kept, nothing has been appended.
            if rejects_dir:
                refused_records(checked).write.mode("append").parquet(rejects_dir)
            tables.append_table(taken.select(schema.names), db, table)
        return append_result(count, refused, valid - count, "appended")

    return report(spark, [attempt_append(table, step)], APPEND_REPORT)
