"""Every query of the library on the sample star schema, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sample
from .functions.dates import hire_date, quarter_label
from .operators.normalise import normalise_history
from .operators.refined import refine_rows
from .plans import history, landing, reports, snapshot
from .plans.refine import refine, refined_name
from .schemas import FACT, TABLES, read_schema, schema_from_text, table_schema
from .session import run_dir
from .sources import csv, tables
from .streaming import epochs
from .streaming import landing as streams

YEAR, EMPTY_YEAR = 1997, 2021

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The sample tables in SQL; each oracle starts with these.
STAR = """
WITH hired_employees AS (
  SELECT o_orderkey AS id,
         concat('emp_', CAST(o_custkey AS VARCHAR)) AS name,
         CASE WHEN o_orderkey % 37 = 0 THEN '0'
              ELSE concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'T00:00:00Z')
         END AS datetime,
         CASE WHEN o_orderkey % 41 = 0 THEN CAST(0 AS BIGINT)
              ELSE o_custkey % 28 + 1 END AS department_id,
         o_orderkey % 7 + 1 AS job_id
  FROM orders),
departments AS (SELECT CAST(n_nationkey AS BIGINT) + 1 AS id, n_name AS department FROM nation),
jobs AS (SELECT CAST(r_regionkey AS BIGINT) + 1 AS id, r_name AS job FROM region),
enriched AS (
  SELECT a.id, a.name, CAST(SUBSTR(NULLIF(a.datetime, '0'), 1, 10) AS DATE) AS hire_date,
         a.department_id, b.department, c.job
  FROM hired_employees a
  LEFT JOIN departments b ON a.department_id = b.id
  LEFT JOIN jobs c ON a.job_id = c.id)
"""

BY_QUARTER = """
  CAST(SUM(CASE WHEN EXTRACT(QUARTER FROM hire_date) = 1 THEN 1 ELSE 0 END) AS BIGINT) AS Q1,
  CAST(SUM(CASE WHEN EXTRACT(QUARTER FROM hire_date) = 2 THEN 1 ELSE 0 END) AS BIGINT) AS Q2,
  CAST(SUM(CASE WHEN EXTRACT(QUARTER FROM hire_date) = 3 THEN 1 ELSE 0 END) AS BIGINT) AS Q3,
  CAST(SUM(CASE WHEN EXTRACT(QUARTER FROM hire_date) = 4 THEN 1 ELSE 0 END) AS BIGINT) AS Q4
"""


def in_year_sql(year: int) -> str:
    return f"EXTRACT(YEAR FROM hire_date) = {year} AND department IS NOT NULL"


def quarter_sql(year: int, source: str = "enriched") -> str:
    return (
        f"SELECT department, job, {BY_QUARTER} FROM {source}"
        f" WHERE {in_year_sql(year)} GROUP BY department, job"
    )


def above_mean_sql(year: int) -> str:
    return f""", p AS (
      SELECT department_id AS id, department, COUNT(*) AS hired
      FROM enriched WHERE {in_year_sql(year)} GROUP BY department_id, department)
    SELECT id, department, hired FROM p WHERE hired > (SELECT AVG(hired) FROM p)"""


def query(key: str, sql: str):
    """Register a query and the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        ORACLES[key] = STAR + sql
        return fn

    return register


def per_table(key: str, sql: str):
    """Register ``fn(spark, sf_dir, table)`` once per table; ``{t}`` in the SQL."""

    def register(fn):
        for table in ("hired_employees", "departments", "jobs"):
            run = lambda spark, sf_dir, t=table: fn(spark, sf_dir, t)
            name = key if table == FACT else f"{key}_{table}"
            query(name, sql.replace("{t}", table))(run)
        return fn

    return register


# ---- enrichment and reports ------------------------------------------------


@query("hires_enriched", "SELECT * FROM enriched")
def _(spark, sf_dir):
    return reports.hires_enriched(*sample.star(spark, sf_dir).values())


@query("hires_enriched_large_lookup", "SELECT * FROM enriched")
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    return reports.hires_enriched(*star.values(), max_rows=0)


@query("hires_in_year", f"SELECT * FROM enriched WHERE {in_year_sql(YEAR)}")
def _(spark, sf_dir):
    return reports.hires_in_year(*sample.star(spark, sf_dir).values(), YEAR)


@query("hires_by_quarter", quarter_sql(YEAR))
def hires_by_quarter(spark, sf_dir):
    return reports.hires_by_quarter(*sample.star(spark, sf_dir).values(), YEAR)


@query("hires_by_quarter_large_lookup", quarter_sql(YEAR))
def _(spark, sf_dir):
    return reports.hires_by_quarter(*sample.star(spark, sf_dir).values(), YEAR, max_rows=0)


@query(
    "hires_by_quarter_repeated_ids",
    f""", twice AS (
      SELECT id, department FROM departments
      UNION ALL SELECT id, concat(department, '_B') FROM departments WHERE id % 3 = 0
      UNION ALL SELECT id, CAST(NULL AS VARCHAR) FROM departments WHERE id % 4 = 0),
    fanned AS (
      SELECT CAST(SUBSTR(NULLIF(a.datetime, '0'), 1, 10) AS DATE) AS hire_date,
             b.department, c.job
      FROM hired_employees a
      LEFT JOIN twice b ON a.department_id = b.id
      LEFT JOIN (SELECT * FROM jobs UNION ALL SELECT * FROM jobs WHERE id = 2) c
        ON a.job_id = c.id)
    {quarter_sql(YEAR, "fanned")}""",
)
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    dep, jobs = star["departments"], star["jobs"]
    dep = dep.unionAll(
        dep.filter("id % 3 = 0").select("id", F.concat("department", F.lit("_B")))
    ).unionAll(dep.filter("id % 4 = 0").select("id", F.lit(None).cast("string")))
    jobs = jobs.unionAll(jobs.filter("id = 2"))
    return reports.hires_by_quarter(star[FACT], dep, jobs, YEAR)


@query(
    "hires_per_quarter_label",
    """SELECT CASE WHEN hire_date IS NOT NULL
                   THEN concat('Q', CAST(EXTRACT(QUARTER FROM hire_date) AS VARCHAR))
              END AS quarter, COUNT(*) AS n
       FROM enriched GROUP BY 1""",
)
def _(spark, sf_dir):
    hires = reports.dated_hires(sample.star(spark, sf_dir)[FACT])
    label = quarter_label(F.col("hire_date")).alias("quarter")
    return hires.groupBy(label).agg(F.count("*").alias("n"))


@query(
    "mean_hires",
    f"""SELECT AVG(hired) AS mean_hires FROM (
          SELECT department_id, department, COUNT(*) AS hired FROM enriched
          WHERE {in_year_sql(YEAR)} GROUP BY department_id, department)""",
)
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    return reports.mean_hires(star[FACT], star["departments"], YEAR)


@query("departments_above_mean", above_mean_sql(YEAR))
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    return reports.departments_above_mean(star[FACT], star["departments"], YEAR)


@query("departments_above_mean_large_lookup", above_mean_sql(YEAR))
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    return reports.departments_above_mean(star[FACT], star["departments"], YEAR, max_rows=0)


@query("above_mean_empty_year", above_mean_sql(EMPTY_YEAR))
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    return reports.departments_above_mean(star[FACT], star["departments"], EMPTY_YEAR)


@query(
    "null_job_group",
    f"""SELECT job, COUNT(*) AS n FROM enriched
        WHERE {in_year_sql(YEAR)} AND job IS NULL GROUP BY job""",
)
def _(spark, sf_dir):
    hires = reports.hires_in_year(*sample.star(spark, sf_dir).values(), YEAR)
    return hires.filter("job IS NULL").groupBy("job").agg(F.count("*").alias("n"))


@query("unmatched_department", "SELECT COUNT(*) AS n FROM enriched WHERE department IS NULL")
def _(spark, sf_dir):
    hires = reports.hires_enriched(*sample.star(spark, sf_dir).values())
    return hires.filter("department IS NULL").agg(F.count("*").alias("n"))


@query("sentinel_count", "SELECT COUNT(*) AS n FROM enriched WHERE hire_date IS NULL")
def _(spark, sf_dir):
    hires = reports.dated_hires(sample.star(spark, sf_dir)[FACT])
    return hires.filter("hire_date IS NULL").agg(F.count("*").alias("n"))


@query(
    "dates_or_null",
    """SELECT id, CASE WHEN id % 5 = 0 OR datetime = '0' THEN NULL
                       ELSE CAST(SUBSTR(datetime, 1, 10) AS DATE) END AS hire_date
       FROM hired_employees""",
)
def _(spark, sf_dir):
    text = F.when(F.col("id") % 5 == 0, F.concat(F.lit("on "), "datetime")).otherwise(
        F.col("datetime")
    )
    hires = sample.star(spark, sf_dir)[FACT]
    return hires.select("id", hire_date(text, on_bad_date="null").alias("hire_date"))


# ---- duplicates and history ------------------------------------------------


@per_table("refine_distinct", "SELECT DISTINCT * FROM {t}")
def _(spark, sf_dir, table):
    return refine_rows(sample.with_even_ids_twice(sample.star(spark, sf_dir)[table]))


@query(
    "refine_hot_copies",
    """SELECT DISTINCT CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id,
              CASE WHEN id % 3 = 0 THEN NULL ELSE name END AS name FROM hired_employees""",
)
def _(spark, sf_dir):
    hot = F.col("id") % 3 == 0
    hires = sample.star(spark, sf_dir)[FACT].select(
        F.when(hot, 0).otherwise(F.col("id")).alias("id"),
        F.when(~hot, F.col("name")).alias("name"),
    )
    return refine_rows(hires)


@query(
    "normalise_history",
    """SELECT o_orderkey AS id,
         CAST(trunc(COALESCE(CASE WHEN o_orderkey % 5 <> 0
                                  THEN o_totalprice - 200000 END, 0)) AS BIGINT) AS balance,
         COALESCE(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END, '0') AS name,
         COALESCE(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END, 0) AS department_id
       FROM orders""",
)
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    return normalise_history(
        orders.select(
            key.alias("id"),
            F.when(key % 5 != 0, F.col("o_totalprice") - 200000).alias("balance"),
            F.when(key % 7 != 0, F.col("o_orderpriority")).alias("name"),
            F.when(key % 3 != 0, F.col("o_custkey")).alias("department_id"),
        )
    )


def _history(spark, sf_dir) -> dict[str, DataFrame]:
    """The star as it looks before normalising: nulls, and integers as floats."""
    star = sample.star(spark, sf_dir)
    hires = star[FACT]
    star[FACT] = hires.select(
        "id",
        F.when(F.col("id") % 6 != 0, F.col("name")).alias("name"),
        F.nullif("datetime", F.lit("0")).alias("datetime"),
        F.nullif("department_id", F.lit(0)).cast("double").alias("department_id"),
        F.col("job_id").cast("double").alias("job_id"),
    )
    return star


NORMALISED = """SELECT id, CASE WHEN id % 6 = 0 THEN '0' ELSE name END AS name, datetime,
                       department_id, job_id FROM hired_employees"""


@query("normalise_files", NORMALISED)
def _(spark, sf_dir):
    source = sample.csv_folder(spark, _history(spark, sf_dir), header=True)
    target = run_dir(spark, "normalised")
    history.normalise_files(spark, source, target)
    return csv.read_declared(spark, f"{target}/{FACT}.csv", table_schema(FACT))


@query("normalise_two_formats", NORMALISED)
def _(spark, sf_dir):
    """One table's history, half of it CSV and half Parquet."""
    hires = _history(spark, sf_dir)[FACT]
    half = F.coalesce(F.col("id") % 2 == 0, F.lit(False))
    source = sample.csv_folder(spark, {FACT: hires.filter(half)}, header=True)
    hires.filter(~half).write.parquet(f"{source}/{FACT}.parquet")
    target = run_dir(spark, "normalised")
    history.normalise_files(spark, source, target)
    return csv.read_declared(spark, f"{target}/{FACT}.csv", table_schema(FACT))


@query("history_to_summary", quarter_sql(YEAR))
def _(spark, sf_dir):
    """Files to report: normalise, ingest, refine, summarise."""
    source = sample.csv_folder(spark, _history(spark, sf_dir), header=True)
    target = run_dir(spark, "normalised")
    history.normalise_files(spark, source, target)
    db, raw_db = sample.database(spark, {}), sample.database(spark, {})
    history.ingest(spark, target, db, raw_db)
    refine(spark, db)
    return reports.summarise_year(spark, db, YEAR)


# ---- ingest and landing ----------------------------------------------------


def _ingest(spark, sf_dir, extra=None):
    star = sample.star(spark, sf_dir)
    doubled = {t: sample.with_even_ids_twice(rows) for t, rows in star.items()}
    source = sample.csv_folder(spark, {**doubled, **(extra or {})})
    db, raw_db = sample.database(spark, {}), sample.database(spark, {})
    return db, raw_db, history.ingest(spark, source, db, raw_db)


@per_table("ingest_csv_distinct", "SELECT DISTINCT * FROM {t}")
def _(spark, sf_dir, table):
    db, _raw, _report = _ingest(spark, sf_dir)
    return spark.table(tables.table_name(db, table))


@query(
    "ingest_raw_table",
    "SELECT * FROM hired_employees UNION ALL SELECT * FROM hired_employees WHERE id % 2 = 0",
)
def _(spark, sf_dir):
    _db, raw_db, _report = _ingest(spark, sf_dir)
    return spark.table(tables.table_name(raw_db, f"{FACT}_raw"))


@query(
    "ingest_report",
    """SELECT 'departments' AS "table", 'ok' AS status, COUNT(*) AS rows FROM departments
       UNION ALL SELECT 'departments_raw', 'ok', NULL
       UNION ALL SELECT 'hired_employees', 'ok', COUNT(*) FROM hired_employees
       UNION ALL SELECT 'hired_employees_raw', 'ok', NULL
       UNION ALL SELECT 'jobs', 'ok', COUNT(*) FROM jobs
       UNION ALL SELECT 'jobs_raw', 'ok', NULL
       UNION ALL SELECT 'customers', 'skipped', NULL""",
)
def _(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    _db, _raw, report = _ingest(spark, sf_dir, {"customers": customers})
    return report.drop("message")


CAPPED = f"""SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY id // {sample.BATCH_ROWS} ORDER BY id) AS n FROM {{t}})
  WHERE n <= {landing.MAX_ROWS}"""


@per_table("append_capped", CAPPED)
def _(spark, sf_dir, table):
    source = sample.landed_csv(spark, sample.star(spark, sf_dir))
    db = sample.database(spark, {})
    landing.append_capped_csv(spark, source, db)
    return spark.table(tables.table_name(db, table))


@query(
    "append_counts",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", 'ok' AS status, COUNT(*) AS rows
            FROM ({CAPPED.replace("{t}", t)})"""
        for t in ("hired_employees", "departments", "jobs")
    ),
)
def _(spark, sf_dir):
    source = sample.landed_csv(spark, sample.star(spark, sf_dir))
    report = landing.append_capped_csv(spark, source, sample.database(spark, {}))
    return report.select("table", "status", "rows")


BAD_BATCH = f"(id // {sample.BATCH_ROWS}) % 2 = 1"


def _with_bad_batches(star):
    """Every second batch gets one row whose department is a word."""
    hires = star[FACT]
    spoilt = (F.expr(f"id div {sample.BATCH_ROWS}") % 2 == 1) & (
        F.col("id") % sample.BATCH_ROWS == 17
    )
    text = F.when(spoilt, "sales").otherwise(F.col("department_id").cast("string"))
    return {FACT: hires.withColumn("department_id", text)}


@query(
    "append_capped_bad_files",
    CAPPED.replace("{t}", FACT)
    + f""" AND NOT ({BAD_BATCH} AND id // {sample.BATCH_ROWS} IN (
        SELECT id // {sample.BATCH_ROWS} FROM hired_employees
        WHERE id % {sample.BATCH_ROWS} = 17))""",
)
def _(spark, sf_dir):
    source = sample.landed_csv(spark, _with_bad_batches(sample.star(spark, sf_dir)))
    db = sample.database(spark, {})
    landing.append_capped_csv(spark, source, db)
    return spark.table(tables.table_name(db, FACT))


# Which batches have a spoilt row, and how a file of a batch is cut.
BATCHES = f"""(SELECT id // {sample.BATCH_ROWS} AS b, COUNT(*) AS n,
    LEAST(COUNT(*), {landing.MAX_ROWS}) AS kept,
    (id // {sample.BATCH_ROWS}) % 2 = 1 AND bool_or(id % {sample.BATCH_ROWS} = 17) AS bad
  FROM hired_employees GROUP BY id // {sample.BATCH_ROWS})"""
REFUSED_REPORT = f"""SELECT 'hired_employees' AS "table",
  CASE WHEN SUM(CASE WHEN bad THEN kept ELSE 0 END) = 0 THEN 'ok'
       WHEN SUM(CASE WHEN bad THEN 0 ELSE kept END) = 0 THEN 'error' ELSE 'partial' END AS status,
  CAST(SUM(CASE WHEN bad THEN 0 ELSE kept END) AS BIGINT) AS rows,
  CAST(SUM(CASE WHEN bad THEN kept ELSE 0 END) AS BIGINT) AS rows_refused,
  CAST(SUM(n - kept) AS BIGINT) AS rows_left_out FROM {BATCHES}"""


@query("append_refused_report", REFUSED_REPORT)
def _(spark, sf_dir):
    source = sample.landed_csv(spark, _with_bad_batches(sample.star(spark, sf_dir)))
    return landing.append_capped_csv(spark, source, sample.database(spark, {})).drop("message")


@query(
    "append_left_out_counts",
    f"""SELECT 'hired_employees' AS "table", CAST(SUM(kept) AS BIGINT) AS rows,
        CAST(SUM(n - kept) AS BIGINT) AS rows_left_out FROM {BATCHES}""",
)
def _(spark, sf_dir):
    source = sample.landed_csv(spark, {FACT: sample.star(spark, sf_dir)[FACT]})
    report = landing.append_capped_csv(spark, source, sample.database(spark, {}))
    return report.select("table", "rows", "rows_left_out")


BLANKED = "SELECT id, CASE WHEN id % 5 = 0 THEN '' ELSE department END AS department FROM departments"


@query(
    "ingest_equals_append",
    f"SELECT 'ingest' AS path, * FROM ({BLANKED}) UNION ALL SELECT 'append', * FROM ({BLANKED})",
)
def _(spark, sf_dir):
    """An empty text is the same by both ways into a table."""
    rows = sample.star(spark, sf_dir)["departments"]
    blanked = rows.withColumn("department", F.expr("CASE WHEN id % 5 = 0 THEN '' ELSE department END"))
    source = run_dir(spark, "blank")
    csv.write(blanked, f"{source}/departments.csv", False)
    by_ingest, raw, by_append = (sample.database(spark, {}) for _ in range(3))
    history.ingest(spark, source, by_ingest, raw)
    landing.append_capped_csv(spark, source, by_append)
    tagged = [
        spark.table(tables.table_name(db, "departments")).select(F.lit(path).alias("path"), "*")
        for path, db in (("ingest", by_ingest), ("append", by_append))
    ]
    return tagged[0].unionByName(tagged[1])


RECORDS_OK = "SELECT * FROM hired_employees WHERE id % 10 NOT IN (2, 3, 4, 5, 6)"
RECORDS_REJECTED = """
SELECT CASE WHEN id % 10 <> 6 THEN id END AS id,
       CASE WHEN id % 10 NOT IN (5, 6) THEN name END AS name,
       CASE WHEN id % 10 <> 6 THEN datetime END AS datetime,
       CASE WHEN id % 10 NOT IN (2, 4, 6) THEN department_id END AS department_id,
       CASE WHEN id % 10 NOT IN (3, 6) THEN job_id END AS job_id
FROM hired_employees WHERE id % 10 IN (2, 3, 4, 5, 6)"""


def _append_records(spark, sf_dir):
    source = sample.landed_records(spark, sample.star(spark, sf_dir)[FACT])
    db, rejects = sample.database(spark, {}), run_dir(spark, "rejects")
    report = landing.append_records(spark, source, db, FACT, rejects_dir=rejects)
    return db, rejects, report


@query("append_records_ok", RECORDS_OK)
def _(spark, sf_dir):
    db, _rejects, _report = _append_records(spark, sf_dir)
    return spark.table(tables.table_name(db, FACT))


@query("append_records_rejected", RECORDS_REJECTED)
def _(spark, sf_dir):
    _db, rejects, _report = _append_records(spark, sf_dir)
    return spark.read.parquet(rejects).select(table_schema(FACT).names)


@query("append_records_count", f"SELECT COUNT(*) AS rows FROM ({RECORDS_OK})")
def _(spark, sf_dir):
    _db, _rejects, report = _append_records(spark, sf_dir)
    return report.select("rows")


# ---- streams ---------------------------------------------------------------


@query("stream_append_capped", CAPPED.replace("{t}", FACT))
def _(spark, sf_dir):
    source = sample.landed_csv(spark, sample.star(spark, sf_dir))
    landed, checkpoint = run_dir(spark, "landed"), run_dir(spark, "checkpoint")
    streams.land_capped_csv(
        spark, f"{source}/{FACT}.csv", FACT, landed, checkpoint
    ).awaitTermination()
    return streams.read_landed(spark, landed, table_schema(FACT))


@query("stream_append_records", RECORDS_OK)
def _(spark, sf_dir):
    source = sample.landed_records(spark, sample.star(spark, sf_dir)[FACT])
    landed, checkpoint = run_dir(spark, "landed"), run_dir(spark, "checkpoint")
    streams.land_records(spark, source, FACT, landed, checkpoint).awaitTermination()
    return streams.read_landed(spark, landed, table_schema(FACT))


@query(
    "stream_rejected",
    f"""SELECT id, name, datetime, job_id FROM (
      SELECT *, row_number() OVER (PARTITION BY id // {sample.BATCH_ROWS} ORDER BY id) AS place
      FROM hired_employees) JOIN {BATCHES} ON b = id // {sample.BATCH_ROWS}
      WHERE bad AND place <= {landing.MAX_ROWS}""",
)
def _(spark, sf_dir):
    """Rows of the files that a stream refuses; their department may be a word."""
    source = sample.landed_csv(spark, _with_bad_batches(sample.star(spark, sf_dir)))
    landed, checkpoint, rejects = (run_dir(spark, x) for x in ("landed", "checkpoint", "rejects"))
    streams.land_capped_csv(
        spark, f"{source}/{FACT}.csv", FACT, landed, checkpoint, rejects_dir=rejects
    ).awaitTermination()
    kept = streams.read_landed(spark, rejects, table_schema(FACT))
    return kept.select("id", "name", "datetime", "job_id")


@query(
    "stream_two_into_one",
    "SELECT * FROM jobs UNION ALL SELECT * FROM jobs",
)
def _(spark, sf_dir):
    """Two streams with checkpoints of their own land in one folder."""
    source = sample.landed_csv(spark, {"jobs": sample.star(spark, sf_dir)["jobs"]})
    landed = run_dir(spark, "landed")
    for _ in range(2):
        streams.land_capped_csv(
            spark, f"{source}/jobs.csv", "jobs", landed, run_dir(spark, "checkpoint")
        ).awaitTermination()
    return streams.read_landed(spark, landed, table_schema("jobs"))


@query(
    "stream_into_table",
    f"SELECT * FROM hired_employees WHERE id % 3 = 0 UNION ALL ({RECORDS_OK})",
)
def _(spark, sf_dir):
    """Records land in a table that has rows; a second run finds nothing new."""
    hires = sample.star(spark, sf_dir)[FACT]
    db = sample.database(spark, {FACT: hires.filter("id % 3 = 0")})
    source, checkpoint = sample.landed_records(spark, hires), run_dir(spark, "checkpoint")
    for _ in range(2):
        streams.stream_records_into(
            spark, source, db, FACT, checkpoint, files_per_batch=3
        ).awaitTermination()
    return spark.table(tables.table_name(db, FACT))


@query(
    "stream_csv_into_table",
    CAPPED.replace("{t}", FACT)
    + f""" AND NOT ({BAD_BATCH} AND id // {sample.BATCH_ROWS} IN (
        SELECT id // {sample.BATCH_ROWS} FROM hired_employees
        WHERE id % {sample.BATCH_ROWS} = 17))""",
)
def _(spark, sf_dir):
    source = sample.landed_csv(spark, _with_bad_batches(sample.star(spark, sf_dir)))
    db, checkpoint = sample.database(spark, {}), run_dir(spark, "checkpoint")
    streams.stream_csv_into(
        spark, f"{source}/{FACT}.csv", db, FACT, checkpoint, files_per_batch=2
    ).awaitTermination()
    return spark.table(tables.table_name(db, FACT))


@query(
    "stream_counts",
    f"""SELECT CAST(SUM(CASE WHEN bad THEN 0 ELSE kept END) AS BIGINT) AS rows,
        CAST(SUM(CASE WHEN bad THEN kept ELSE 0 END) AS BIGINT) AS rows_refused,
        CAST(SUM(n - kept) AS BIGINT) AS rows_left_out,
        CAST(CEIL(COUNT(*) / 2) AS BIGINT) AS epochs FROM {BATCHES}""",
)
def _(spark, sf_dir):
    """What the epochs of a stream say of the rows that came; nothing else is kept."""
    source = sample.landed_csv(spark, _with_bad_batches(sample.star(spark, sf_dir)))
    db, checkpoint = sample.database(spark, {}), run_dir(spark, "checkpoint")
    streams.stream_csv_into(
        spark, f"{source}/{FACT}.csv", db, FACT, checkpoint, files_per_batch=2
    ).awaitTermination()
    sums = [F.sum(c).alias(c) for c in epochs.COUNTS]
    return epochs.epochs_of(spark, db, FACT).agg(*sums, F.count("*").alias("epochs"))


@query(
    "stream_folder_counts",
    f"""SELECT COUNT(*) AS rows_seen, COUNT(*) FILTER (WHERE id % 10 IN (2, 3, 4, 5, 6)) AS rows_refused
        FROM hired_employees""",
)
def _(spark, sf_dir):
    """The same of a stream that lands in a folder."""
    source = sample.landed_records(spark, sample.star(spark, sf_dir)[FACT])
    landed, checkpoint = run_dir(spark, "landed"), run_dir(spark, "checkpoint")
    streams.land_records(spark, source, FACT, landed, checkpoint, files_per_batch=2).awaitTermination()
    counts = streams.landed_counts(spark, landed)
    return counts.agg(
        F.sum(F.col("rows") + F.col("rows_refused") + F.col("rows_left_out")).alias("rows_seen"),
        F.sum("rows_refused").alias("rows_refused"),
    )


# ---- snapshots and refined tables ------------------------------------------


@per_table("backup_restore_one", "SELECT * FROM {t} UNION ALL SELECT * FROM {t}")
def _(spark, sf_dir, table):
    db = sample.database(spark, {table: sample.star(spark, sf_dir)[table]})
    folder = run_dir(spark, "backup")
    snapshot.backup_table(spark, db, folder, table)
    snapshot.restore_table(spark, folder, db, table)
    return spark.table(tables.table_name(db, table))


COUNTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", COUNT(*) AS rows FROM {t}"""
    for t in ("hired_employees", "departments", "jobs")
)


@query("backup_restore_all", COUNTS)
def _(spark, sf_dir):
    source, target = sample.database(spark, sample.star(spark, sf_dir)), sample.database(spark, {})
    folder = run_dir(spark, "backup")
    snapshot.backup_tables(spark, source, folder)
    snapshot.restore_tables(spark, folder, target)
    counts = [
        spark.table(tables.table_name(target, t)).agg(
            F.lit(t).alias("table"), F.count("*").alias("rows")
        )
        for t in tables.list_tables(spark, target)
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@query(
    "backup_replaces_older",
    "SELECT id, upper(name) AS name, datetime, department_id, job_id FROM hired_employees",
)
def _(spark, sf_dir):
    """A second snapshot takes the first one's place; overwrite restores it alone."""
    hires = sample.star(spark, sf_dir)[FACT]
    folder = run_dir(spark, "backup")
    first = sample.database(spark, {FACT: hires})
    snapshot.backup_table(spark, first, folder, FACT)
    second = sample.database(spark, {FACT: hires.withColumn("name", F.upper("name"))})
    snapshot.backup_table(spark, second, folder, FACT)
    snapshot.restore_table(spark, folder, first, FACT, mode="overwrite")
    return spark.table(tables.table_name(first, FACT))


@per_table("restore_then_refine", "SELECT DISTINCT * FROM {t}")
def _(spark, sf_dir, table):
    db = sample.database(spark, {table: sample.star(spark, sf_dir)[table]})
    folder = run_dir(spark, "backup")
    snapshot.backup_table(spark, db, folder, table)
    snapshot.restore_table(spark, folder, db, table)
    refine(spark, db)
    refined = spark.table(tables.table_name(db, refined_name(table)))
    return refined.select(table_schema(table).names)


@query("refine_counts", COUNTS)
def _(spark, sf_dir):
    star = sample.star(spark, sf_dir)
    db = sample.database(spark, {t: sample.with_even_ids_twice(r) for t, r in star.items()})
    return refine(spark, db).select("table", "rows")


@query("refined_summary", quarter_sql(YEAR))
def _(spark, sf_dir):
    db = sample.database(spark, sample.star(spark, sf_dir))
    refine(spark, db)
    return reports.summarise_year(spark, db, YEAR)


@query(
    "refined_by_year",
    """SELECT CAST(EXTRACT(YEAR FROM hire_date) AS INTEGER) AS hire_year, COUNT(*) AS rows,
              MIN(hire_date) AS first_hire FROM enriched GROUP BY 1""",
)
def _(spark, sf_dir):
    """The partitions of the refined facts; hires without a date have a null one."""
    db = sample.database(spark, sample.star(spark, sf_dir))
    refine(spark, db, [FACT])
    refined = spark.table(tables.table_name(db, refined_name(FACT)))
    return refined.groupBy("hire_year").agg(F.count("*").alias("rows"), F.min("hire_date").alias("first_hire"))


@query("replaced_by_own_rows", "SELECT DISTINCT id, upper(name) AS name FROM hired_employees")
def _(spark, sf_dir):
    """A table is replaced by what it holds, then by other columns of itself."""
    db = sample.database(spark, {FACT: sample.with_even_ids_twice(sample.star(spark, sf_dir)[FACT])})
    name = tables.table_name(db, FACT)
    tables.replace_table(refine_rows(spark.table(name)), db, FACT)
    tables.replace_table(spark.table(name).select("id", F.upper("name").alias("name")), db, FACT)
    return spark.table(name)


@query("refined_above_mean", above_mean_sql(YEAR))
def _(spark, sf_dir):
    db = sample.database(spark, sample.star(spark, sf_dir))
    refine(spark, db)
    return reports.store_departments_above_mean(spark, db, YEAR)


@query(
    "snapshot_manifests",
    """SELECT 'backup' AS step, t AS "table", 'AVRO' AS format, 'ok' AS status
       FROM (SELECT unnest(['departments', 'hired_employees', 'jobs']) AS t)
       UNION ALL SELECT 'restore', t, 'AVRO', 'ok'
       FROM (SELECT unnest(['departments', 'hired_employees', 'jobs']) AS t)""",
)
def _(spark, sf_dir):
    """What a backup of all tables and their restore report."""
    db, other = sample.database(spark, sample.star(spark, sf_dir)), sample.database(spark, {})
    folder = run_dir(spark, "backup")
    written = snapshot.backup_tables(spark, db, folder)
    loaded = snapshot.restore_tables(spark, folder, other)
    return written.select(
        F.lit("backup").alias("step"), F.col("table_id").alias("table"), "format", "status"
    ).union(
        loaded.select(
            F.lit("restore"), F.substring_index("destination_table", ".", -1), "format_file", "status"
        )
    )


@query("schema_from_text", "SELECT * FROM hired_employees")
def _(spark, sf_dir):
    """CSV under a schema that is read from a definition text."""
    source = sample.csv_folder(spark, {FACT: sample.star(spark, sf_dir)[FACT]})
    return csv.read_declared(spark, f"{source}/{FACT}.csv", schema_from_text(_definition(FACT)))


def _definition(table: str) -> str:
    """A table's definition as a text: one column a line, integers by their other name."""
    return TABLES[table].replace("BIGINT", "INT64").replace(", ", ",\n")


@query("schema_from_file", "SELECT * FROM hired_employees")
def _(spark, sf_dir):
    """The definition comes from a file beside the CSV."""
    source = sample.csv_folder(spark, {FACT: sample.star(spark, sf_dir)[FACT]})
    definition = spark.range(1).select(F.lit(_definition(FACT)).alias("value"))
    definition.write.text(f"{source}/{FACT}.txt")
    schema = read_schema(spark, f"{source}/{FACT}.txt")
    return csv.read_declared(spark, f"{source}/{FACT}.csv", schema)
