"""The two yearly reports and the enriched facts below them.

Facts may be a base table or a refined one; a refined table's stored
``hire_date`` is used if there.

The reports never shuffle hires, only counts, so a department or job with a
large share of the hires is no hot key. Lookup tables that measure small are
broadcast, and hires are counted per name in the tasks that read them. With
larger ones hires are first counted per id, and the names are joined to the
counts; an id that repeats in a lookup table multiplies the counts as it would
multiply the hires. ``limits`` are those of ``are_small``. Whatever the sizes, a
report is lazy: making one reads lookup tables, but no hire.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import hire_date, in_year
from ..operators.lookup import are_small, lookup_join
from ..operators.refined import BAD_YEAR, HIRE_YEAR
from ..schemas import FACT
from ..sources import tables
from .refine import refined_name

QUARTERS = (1, 2, 3, 4)


def _is_stored(fact: DataFrame) -> bool:
    return {"hire_date", "bad_date"} <= set(fact.columns)


def dated_hires(fact: DataFrame, on_bad_date: str = "raise") -> DataFrame:
    """Facts with ``hire_date`` in place of the date text."""
    if not _is_stored(fact):
        dated = fact.withColumn("hire_date", hire_date(F.col("datetime"), on_bad_date))
        return dated.drop("datetime")
    if on_bad_date == "raise":
        refuse = F.raise_error(F.lit("a refined hire has a text that is no date")).cast("date")
        date = F.when(F.col("bad_date"), refuse).otherwise(F.col("hire_date"))
        fact = fact.withColumn("hire_date", date)
    return fact.drop("datetime", "bad_date", HIRE_YEAR)


def hires_of_year(fact: DataFrame, year: int, on_bad_date: str = "raise") -> DataFrame:
    """Dated facts of one year."""
    if _is_stored(fact):
        # A condition that file statistics can answer; a bad date of any year
        # has to be met as well if it shall fail the query.
        wanted = in_year(F.col("hire_date"), year)
        if HIRE_YEAR in fact.columns:
            # Partitions of other years are not even listed.
            years = [year, BAD_YEAR] if on_bad_date == "raise" else [year]
            fact = fact.filter(F.col(HIRE_YEAR).isin(years))
        fact = fact.filter(wanted | F.col("bad_date") if on_bad_date == "raise" else wanted)
    elif on_bad_date == "null":
        # Every parsed date starts with its four year digits; Parquet can skip on it.
        fact = fact.filter(F.col("datetime").startswith(f"{year:04d}-"))
    return dated_hires(fact, on_bad_date).filter(F.year("hire_date") == year)


def hires_enriched(
    fact: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
    on_bad_date: str = "raise",
    **limits: int,
) -> DataFrame:
    """Every hire with its date, department and job; nulls where unknown."""
    return _enriched(dated_hires(fact, on_bad_date), departments, jobs, limits)


def hires_in_year(
    fact: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
    year: int,
    on_bad_date: str = "raise",
    **limits: int,
) -> DataFrame:
    """Enriched hires of one year that have a department."""
    hires = hires_of_year(fact, year, on_bad_date)
    rows = _enriched(hires, departments, jobs, limits)
    return rows.filter(F.col("department").isNotNull())


def _enriched(hires, departments, jobs, limits) -> DataFrame:
    departments, jobs = departments.select("id", "department"), jobs.select("id", "job")
    few_departments, few_jobs = are_small(departments, jobs, **limits)
    named = lookup_join(hires, departments, "department_id", "id", small=few_departments)
    named = lookup_join(named, jobs, "job_id", "id", small=few_jobs)
    return named.select("id", "name", "hire_date", "department_id", "department", "job")


def hires_by_quarter(
    fact: DataFrame,
    departments: DataFrame,
    jobs: DataFrame,
    year: int,
    on_bad_date: str = "raise",
    **limits: int,
) -> DataFrame:
    """Hires per department name, job name and quarter of one year.

    An unknown job is a group of its own; an unknown department is left out.
    """
    rows = hires_of_year(fact, year, on_bad_date)
    totals = [F.count_if(F.quarter("hire_date") == q).alias(f"Q{q}") for q in QUARTERS]
    departments, jobs = departments.select("id", "department"), jobs.select("id", "job")
    few_departments, few_jobs = are_small(departments, jobs, **limits)
    if not (few_departments and few_jobs):
        # Counts are joined in place of hires.
        rows = rows.groupBy("department_id", "job_id").agg(*totals)
        totals = [F.sum(f"Q{q}").alias(f"Q{q}") for q in QUARTERS]
    named = lookup_join(rows, departments, "department_id", "id", small=few_departments)
    named = named.filter(F.col("department").isNotNull())
    named = lookup_join(named, jobs, "job_id", "id", small=few_jobs)
    return named.groupBy("department", "job").agg(*totals).orderBy("department", "job")


def department_hires(
    fact: DataFrame,
    departments: DataFrame,
    year: int,
    on_bad_date: str = "raise",
    **limits: int,
) -> DataFrame:
    """Hires of one year per department with at least one."""
    rows = hires_of_year(fact, year, on_bad_date).select("department_id")
    total = F.count("*")
    departments = departments.select("id", "department")
    (few_departments,) = are_small(departments, **limits)
    if not few_departments:
        rows = rows.groupBy("department_id").agg(total.alias("hires"))
        total = F.sum("hires")
    # Lookups are broadcast, or joined to one count per key: no key is hot.
    named = lookup_join(rows, departments, "department_id", "id", small=few_departments)
    named = named.filter(F.col("department").isNotNull())
    group = [F.col("department_id").alias("id"), "department"]
    return named.groupBy(*group).agg(total.alias("hired"))


def mean_hires(
    fact: DataFrame,
    departments: DataFrame,
    year: int,
    on_bad_date: str = "raise",
    **limits: int,
) -> DataFrame:
    """Mean hires of a department, over those with at least one; one row."""
    hired = department_hires(fact, departments, year, on_bad_date, **limits)
    return hired.agg(F.avg("hired").alias("mean_hires"))


def departments_above_mean(
    fact: DataFrame,
    departments: DataFrame,
    year: int,
    on_bad_date: str = "raise",
    **limits: int,
) -> DataFrame:
    """Departments with more hires than the mean, most hires first.

    The mean is a scalar subquery over the same counts, so the facts are read
    once and nothing returns to the driver in between.
    """
    hired = department_hires(fact, departments, year, on_bad_date, **limits)
    mean = hired.agg(F.avg("hired")).scalar()
    return hired.filter(F.col("hired") > mean).orderBy(F.desc("hired"), "id")


def _refined(spark: SparkSession, db: str, table: str) -> DataFrame:
    return spark.table(tables.table_name(db, refined_name(table)))


def summarise_year(
    spark: SparkSession, db: str, year: int, on_bad_date: str = "raise"
) -> DataFrame:
    """Quarter counts from the refined tables, stored as ``{year}_summarize``."""
    result = hires_by_quarter(
        _refined(spark, db, FACT),
        _refined(spark, db, "departments"),
        _refined(spark, db, "jobs"),
        year,
        on_bad_date,
    )
    name = f"{year}_summarize"
    tables.replace_table(result, db, name)
    return spark.table(tables.table_name(db, name)).orderBy("department", "job")


def store_departments_above_mean(
    spark: SparkSession, db: str, year: int, on_bad_date: str = "raise"
) -> DataFrame:
    """Departments above the mean from the refined tables, as ``higher_hiring``."""
    result = departments_above_mean(
        _refined(spark, db, FACT), _refined(spark, db, "departments"), year, on_bad_date
    )
    tables.replace_table(result, db, "higher_hiring")
    return spark.table(tables.table_name(db, "higher_hiring")).orderBy(F.desc("hired"), "id")
