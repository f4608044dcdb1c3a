"""Duplicate removal and the layout of refined tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import decode_missing, hire_date


def refine_rows(df: DataFrame) -> DataFrame:
    """One row of each group of fully equal rows; nulls are equal here.

    Copies collapse in the tasks that read them, before the shuffle, so a large
    group of copies costs one row per task.
    """
    return df.distinct()


# The partition column of refined facts, and its value for a text that is no date:
# a year of its own, so that reports that refuse such texts need not look for them.
HIRE_YEAR = "hire_year"
BAD_YEAR = -1


def with_stored_date(refined: DataFrame) -> DataFrame:
    """Refined facts plus ``hire_date``, ``bad_date`` and ``hire_year``.

    Reports need not read the text, and open the files of their year only. A text
    that is no date is kept, with a null date and the flag set; reports decide
    what it means. Hires without a date have a null year.
    """
    text = F.col("datetime")
    return (
        refined.withColumn("hire_date", hire_date(text, on_bad_date="null"))
        .withColumn("bad_date", F.col("hire_date").isNull() & decode_missing(text).isNotNull())
        .withColumn(HIRE_YEAR, F.when(F.col("bad_date"), BAD_YEAR).otherwise(F.year("hire_date")))
    )


def gathered_by_year(dated: DataFrame) -> DataFrame:
    """Rows of one year in few tasks of a good size, ordered by date: a few large files a year.

    Adaptive execution sizes the tasks from what was shuffled: it splits a large
    year over many and merges small ones.
    """
    return dated.hint("rebalance", HIRE_YEAR).sortWithinPartitions(HIRE_YEAR, "hire_date")
