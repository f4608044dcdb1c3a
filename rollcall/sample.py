"""The star schema derived from order tables, and files in the input layouts.

Every rule below is a function of the order key, so that SQL can state the same
rows. Nothing here is sampled or limited.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import run_dir
from .sources import csv, tables

# Rows of one landed file: more than the cap, so that the cap is at work.
BATCH_ROWS = 4000


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Hires from orders, departments from nations, jobs from regions."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")
    zero = F.lit(0).cast("bigint")
    hires = read("orders").select(
        key.alias("id"),
        F.concat(F.lit("emp_"), F.col("o_custkey").cast("string")).alias("name"),
        F.when(key % 37 == 0, "0")
        .otherwise(F.concat(day, F.lit("T00:00:00Z")))
        .alias("datetime"),
        F.when(key % 41 == 0, zero).otherwise(F.col("o_custkey") % 28 + 1).alias("department_id"),
        (key % 7 + 1).alias("job_id"),
    )
    departments = read("nation").select(
        (F.col("n_nationkey").cast("bigint") + 1).alias("id"), F.col("n_name").alias("department")
    )
    jobs = read("region").select(
        (F.col("r_regionkey").cast("bigint") + 1).alias("id"), F.col("r_name").alias("job")
    )
    return {"hired_employees": hires, "departments": departments, "jobs": jobs}


def with_even_ids_twice(df: DataFrame) -> DataFrame:
    return df.unionAll(df.filter("id % 2 = 0"))


def database(spark: SparkSession, star_tables: dict[str, DataFrame]) -> str:
    """A new database below the shared folder, holding the given tables."""
    path = run_dir(spark, "db")
    db = "rollcall_" + path.rsplit("-", 1)[1]
    tables.create_database(spark, db, path)
    for table, rows in star_tables.items():
        tables.append_table(rows, db, table)
    return db


def csv_folder(spark: SparkSession, star_tables: dict[str, DataFrame], header=False) -> str:
    """``{table}.csv`` entries, as many part files each as the rows have partitions."""
    folder = run_dir(spark, "csv")
    for table, rows in star_tables.items():
        csv.write(rows, f"{folder}/{table}.csv", header)
    return folder


def _in_batches(df: DataFrame) -> DataFrame:
    """One partition and one file per batch of ids, in id order."""
    batches = df.withColumn("batch", F.expr(f"id div {BATCH_ROWS}"))
    return batches.repartition("batch").sortWithinPartitions("batch", "id")


def landed_csv(spark: SparkSession, star_tables: dict[str, DataFrame]) -> str:
    """``{table}.csv/batch=n/*.csv``, one file per batch."""
    folder = run_dir(spark, "landing")
    for table, rows in star_tables.items():
        _in_batches(rows).write.partitionBy("batch").csv(f"{folder}/{table}.csv")
    return folder


def landed_records(spark: SparkSession, hires: DataFrame) -> str:
    """JSON lines of hires, some broken by the last digit of the id:

    1: id as digits in quotes (fits), 2: no department, 3: job is a word,
    4: department has a fraction, 5: null name, 6: no JSON at all.
    """
    folder = run_dir(spark, "records")
    digit = F.col("id") % 10
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    number = lambda c: F.col(c).cast("string")
    parts = F.concat_ws(
        ", ",
        F.concat(F.lit('"id": '), F.when(digit == 1, quoted("id")).otherwise(number("id"))),
        F.concat(F.lit('"name": '), F.when(digit == 5, F.lit("null")).otherwise(quoted("name"))),
        F.concat(F.lit('"datetime": '), quoted("datetime")),
        F.when(digit == 4, F.lit('"department_id": 1.5')).when(
            digit != 2, F.concat(F.lit('"department_id": '), number("department_id"))
        ),
        F.concat(F.lit('"job_id": '), F.when(digit == 3, F.lit('"abc"')).otherwise(number("job_id"))),
    )
    line = F.when(digit == 6, F.lit("{not json}")).otherwise(
        F.concat(F.lit("{"), parts, F.lit("}"))
    )
    _in_batches(hires).select(line.alias("value"), "batch").write.partitionBy("batch").text(folder)
    return folder


