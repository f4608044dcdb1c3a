"""Avro snapshots of tables, and restoring them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import avro, files, tables
from .status import attempt, for_each_table, report

# File suffix, format name, and columns of the two manifests.
SUFFIX = ".avro"
FORMAT = "AVRO"
BACKUP_MANIFEST = (
    "table_id STRING, destination_uri STRING, format STRING, status STRING, message STRING"
)
RESTORE_MANIFEST = (
    "source STRING, destination_table STRING, format_file STRING, status STRING, message STRING"
)


def snapshot_path(backup_dir: str, table: str) -> str:
    return f"{backup_dir.rstrip('/')}/{table}{SUFFIX}"


def backup_tables(
    spark: SparkSession, db: str, backup_dir: str, names: list[str] | None = None
) -> DataFrame:
    """Write ``{table}.avro`` for the given tables, by default for all.

    A snapshot takes the place of an older one only once it is complete.
    """

    def one(table: str) -> list[dict]:
        target = snapshot_path(backup_dir, table)

        def step():
            unfinished = f"{backup_dir.rstrip('/')}/_unfinished/{table}{SUFFIX}"
            avro.write(spark.table(tables.table_name(db, table)), unfinished)
            files.replace_folder(spark, unfinished, target)
            return "written", None

        done = attempt(table, step)
        return [
            dict(
                table_id=table,
                destination_uri=target,
                format=FORMAT,
                status=done["status"],
                message=done["message"],
            )
        ]

    wanted = tables.list_tables(spark, db) if names is None else names
    return report(spark, for_each_table(spark, wanted, one), BACKUP_MANIFEST)


def backup_table(spark: SparkSession, db: str, backup_dir: str, table: str) -> DataFrame:
    return backup_tables(spark, db, backup_dir, [table])


def restore_tables(
    spark: SparkSession,
    backup_dir: str,
    db: str,
    names: list[str] | None = None,
    mode: str = "append",
) -> DataFrame:
    """Load ``{table}.avro`` into its table, by default every one in the folder.

    ``mode="append"`` adds to what the table holds; ``"overwrite"`` replaces it.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    load = tables.append_table if mode == "append" else tables.replace_table

    def one(table: str) -> list[dict]:
        source = snapshot_path(backup_dir, table)

        def step():
            load(avro.read(spark, files.current(spark, source)), db, table)
            return "loaded", None

        done = attempt(table, step)
        return [
            dict(
                source=source,
                destination_table=f"{db}.{table}",
                format_file=FORMAT,
                status=done["status"],
                message=done["message"],
            )
        ]

    wanted = files.tables_in(spark, backup_dir, SUFFIX) if names is None else names
    return report(spark, for_each_table(spark, wanted, one), RESTORE_MANIFEST)


def restore_table(
    spark: SparkSession, backup_dir: str, db: str, table: str, mode: str = "append"
) -> DataFrame:
    return restore_tables(spark, backup_dir, db, [table], mode)
