"""Base tables -> refined tables without duplicate rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.refined import HIRE_YEAR, gathered_by_year, refine_rows, with_stored_date
from ..schemas import FACT, TABLES, table_schema
from ..session import bytes_of_plan, sized_session
from ..sources import tables
from ..streaming.landing import read_landed
from .status import attempt, for_each_table, report

SUFFIX = "_refined"


def refined_name(table: str) -> str:
    return f"{table}{SUFFIX}"


def refine(
    spark: SparkSession,
    db: str,
    names: list[str] | None = None,
    landed_dirs: dict[str, str] | None = None,
) -> DataFrame:
    """Write ``{table}_refined`` for the given base tables, by default for all
    known ones in the database.

    ``landed_dirs`` names folders filled by the streams, per table, whose rows
    are refined together with the base table's.
    """
    if names is None:
        names = [t for t in tables.list_tables(spark, db) if t in TABLES]
    landed_dirs = landed_dirs or {}

    def one(table: str) -> list[dict]:
        def step():
            def rows_of(session: SparkSession) -> DataFrame:
                rows = session.table(tables.table_name(db, table))
                if table not in landed_dirs:
                    return rows
                return rows.unionByName(read_landed(session, landed_dirs[table], table_schema(table)))

            # Shuffles of a whole table have as many partitions as it needs.
            own = sized_session(spark, bytes_of_plan(rows_of(spark)))
            rows, partitions = refine_rows(rows_of(own)), []
            if table == FACT:
                rows, partitions = gathered_by_year(with_stored_date(rows)), [HIRE_YEAR]
            tables.replace_table(rows, db, refined_name(table), partitions, spark)
            return "refined", spark.table(tables.table_name(db, refined_name(table))).count()

        return [attempt(table, step)]

    return report(spark, for_each_table(spark, names, one))
