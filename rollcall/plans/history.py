"""History files: normalise them, then load them as raw and base tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.normalise import normalise_history
from ..operators.refined import refine_rows
from ..schemas import TABLES, history_schema, table_schema
from ..session import bytes_of_plan, sized_session
from ..sources import csv, files, tables
from .status import ERROR, OK, SKIPPED, attempt, for_each_table, report

NO_SCHEMA = "no schema for this table"
HISTORY_FORMATS = (".csv", ".parquet")


def read_history(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """One table's history: Parquet with its own types, or CSV as declared."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path).select(schema.names)
    return csv.read_declared(spark, path, history_schema(schema), header)


def normalise_files(
    spark: SparkSession,
    src_dir: str,
    dst_dir: str,
    *,
    read_header: bool = True,
    write_header: bool = False,
) -> DataFrame:
    """``{table}.csv`` / ``{table}.parquet`` -> normalised ``{table}.csv``.

    A table that has both formats gets the rows of both. The message of each
    report row is the path written.
    """
    found: dict[str, list[str]] = {}
    for suffix in HISTORY_FORMATS:
        for table, path in files.tables_in(spark, src_dir, suffix).items():
            found.setdefault(table, []).append(path)

    def one(table: str) -> list[dict]:
        if table not in TABLES:
            return [dict(table=table, status=SKIPPED, message=NO_SCHEMA, rows=None)]
        target = f"{dst_dir.rstrip('/')}/{table}.csv"

        def step():
            schema = table_schema(table)
            parts = [normalise_history(read_history(spark, p, schema, read_header)) for p in found[table]]
            csv.write(reduce(DataFrame.unionByName, parts), target, write_header)
            return target, None

        return [attempt(table, step)]

    return report(spark, for_each_table(spark, found, one))


def ingest(
    spark: SparkSession,
    src_dir: str,
    db: str,
    raw_db: str,
    schemas: dict[str, T.StructType] | None = None,
    header: bool = False,
) -> DataFrame:
    """``{table}.csv`` -> external ``{raw_db}.{table}_raw`` -> distinct ``{db}.{table}``.

    A first line counts as data unless ``header`` is set. Each step has its
    report row. Without a raw table the base table is left as it is.
    """
    known = schemas or {table: table_schema(table) for table in TABLES}
    found = files.tables_in(spark, src_dir, ".csv")

    def one(table: str) -> list[dict]:
        if table not in known:
            return [dict(table=table, status=SKIPPED, message=NO_SCHEMA, rows=None)]
        raw = tables.table_name(raw_db, f"{table}_raw")
        staged: list[tables.Staged] = []

        def stage_base():
            # The only pass over the files: it parses and checks them as well.
            own = sized_session(spark, bytes_of_plan(csv.read_lines(spark, found[table])))
            parsed = csv.read_declared(own, found[table], known[table], header)
            staged.append(tables.stage_table(refine_rows(csv.text_for_null(parsed)), db, table, spark=spark))
            return "created", None

        def create_raw():
            if not spark.catalog.databaseExists(raw_db):
                raise ValueError(f"no database {raw_db}")
            base.update(attempt(table, stage_base))
            if base["status"] == ERROR and csv.OPEN_QUOTE in base["message"]:
                raise ValueError(base["message"])
            csv.create_raw_table(spark, raw, found[table], known[table], header)
            return "created", None

        def create_base():
            staged[0].publish()
            return "created", spark.table(tables.table_name(db, table)).count()

        base: dict = {}
        rows = [attempt(f"{table}_raw", create_raw)]
        if rows[0]["status"] != OK:
            for version in staged:
                version.discard()
            base = dict(table=table, status=SKIPPED, message="no raw table", rows=None)
        elif base["status"] == OK:
            base = attempt(table, create_base)
        return [*rows, base]

    return report(spark, for_each_table(spark, found, one))
