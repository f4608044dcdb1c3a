"""Per-table jobs and the small frames that report on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

OK, PARTIAL, ERROR, SKIPPED = "ok", "partial", "error", "skipped"
REPORT = "table STRING, status STRING, message STRING, rows BIGINT"
# What came and was not appended: rows that do not fit (with all of their file,
# for CSV), and rows beyond a bound.
APPEND_REPORT = f"{REPORT}, rows_refused BIGINT, rows_left_out BIGINT"


def for_each_table(
    spark: SparkSession, tables: Iterable[str], job: Callable[[str], list[dict]]
) -> list[dict]:
    """Run one job per table at the same time; rows come back in table order.

    The jobs share nothing, so a small table need not wait for a large one.
    """
    names = sorted(tables)
    if not names:
        return []
    with ThreadPoolExecutor(max_workers=min(len(names), 8)) as pool:
        parts = pool.map(inheritable_thread_target(spark)(job), names)
        return [row for part in parts for row in part]


def attempt(table: str, step: Callable[[], tuple[str, int | None]]) -> dict:
    """Report of one step; an error becomes a row and does not stop the others."""
    try:
        message, rows = step()
        return {"table": table, "status": OK, "message": message, "rows": rows}
    except Exception as error:  # noqa: BLE001 - whatever Spark raises is reported
        return {"table": table, "status": ERROR, "message": str(error), "rows": None}


def append_result(rows: int, refused: int, left_out: int, message: str) -> dict:
    """Outcome of an append: an error if all that came was refused, partial if some was."""
    status = OK if not refused else PARTIAL if rows else ERROR
    return dict(status=status, message=message, rows=rows, rows_refused=refused, rows_left_out=left_out)


def attempt_append(table: str, step: Callable[[], dict]) -> dict:
    try:
        return {"table": table} | step()
    except Exception as error:  # noqa: BLE001 - whatever Spark raises is reported
        nothing = dict(rows=None, rows_refused=None, rows_left_out=None)
        return {"table": table, "status": ERROR, "message": str(error)} | nothing


def report(spark: SparkSession, rows: list[dict], schema: str = REPORT) -> DataFrame:
    return spark.createDataFrame(rows, schema)
