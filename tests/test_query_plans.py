"""What the physical plans must and must not contain."""

import pathlib

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from rollcall import catalogue, sample
from rollcall.operators.normalise import normalise_history
from rollcall.operators.refined import refine_rows
from rollcall.plans import landing, reports
from rollcall.plans import refine as refining
from rollcall.plans.refine import refine
from rollcall.schemas import history_schema, table_schema
from rollcall.session import bytes_of_plan
from rollcall.sources import csv, records, tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def refined(spark):
    db = sample.database(spark, sample.star(spark, SF_DIR))
    refine(spark, db)
    return [spark.table(f"{db}.{t}_refined") for t in ("hired_employees", "departments", "jobs")]


@pytest.mark.parametrize(
    "key", ["hires_enriched", "hires_by_quarter", "departments_above_mean", "normalise_history"]
)
def test_no_cross_join_and_no_python(spark, key):
    plan = plan_of(catalogue.QUERIES[key](spark, SF_DIR))
    for word in ("Cartesian", "NestedLoop", "Python", "Pandas"):
        assert word not in plan


def test_stored_dates_reach_the_scan(refined):
    plan = plan_of(reports.hires_by_quarter(*refined, 1997))
    scan = next(line for line in plan.splitlines() if "hired_employees_refined" in line)
    assert "GreaterThanOrEqual(hire_date,1997-01-01)" in scan
    assert "ReadSchema: struct<department_id:bigint,job_id:bigint,hire_date:date,bad_d" in scan
    assert "name#" not in scan and "datetime#" not in scan


def test_lenient_year_reaches_the_scan(spark):
    db = sample.database(spark, sample.star(spark, SF_DIR))
    fact, dep, jobs = [spark.table(f"{db}.{t}") for t in ("hired_employees", "departments", "jobs")]
    plan = plan_of(reports.hires_by_quarter(fact, dep, jobs, 1997, on_bad_date="null"))
    assert "StringStartsWith(datetime,1997-)" in plan


def test_small_lookups_are_joined_where_hires_are_read(refined):
    plan = plan_of(reports.hires_by_quarter(*refined, 1997), run=False)
    assert plan.count("BroadcastHashJoin") == 2
    assert plan.index("partial_count") < plan.index("Join")
    assert plan.count("Exchange hashpartitioning") == 1


def test_large_lookups_are_joined_to_counts(refined):
    plan = plan_of(reports.hires_by_quarter(*refined, 1997, max_rows=0), run=False)
    assert plan.count("hired_employees_refined") == 1 and "ExistingRDD" not in plan
    assert plan.index("Join") < plan.rindex("partial_count") < plan.index("hired_employees_refined")
    plan = plan_of(reports.department_hires(*refined[:2], 1997, max_rows=0), run=False)
    assert plan.rindex("Join") < plan.index("partial_count")


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_facts_are_read_once_for_mean_and_filter(refined, limits):
    plan = plan_of(reports.departments_above_mean(refined[0], refined[1], 1997, **limits))
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert final.count("hired_employees_refined[") <= 1


def test_copies_collapse_before_the_shuffle(spark):
    hires = sample.star(spark, SF_DIR)["hired_employees"]
    plan = plan_of(refine_rows(hires), run=False)
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert plan.rindex("HashAggregate") > plan.index("Exchange")


def test_text_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,a\n")
    schema = table_schema("jobs")
    lines = landing.line_heads(csv.read_lines(spark, str(tmp_path)), schema)
    assert plan_of(lines, run=False).count("from_csv") == 1
    found = records.read_records(spark, str(tmp_path))
    assert plan_of(landing.checked_records(found, schema), run=False).count("from_json") == 1


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_making_a_report_reads_no_hire(spark, tmp_path, limits):
    _, departments, jobs = sample.star(spark, SF_DIR).values()
    schema = table_schema("hired_employees")
    empty = str(tmp_path / "gone")
    spark.createDataFrame([], schema).write.parquet(empty)
    fact = spark.read.schema(schema).parquet(empty)
    fact = fact.withColumn("name", F.raise_error(F.lit("a hire was read")).cast("string"))
    fact = fact.unionByName(spark.range(1).select(*[
        F.raise_error(F.lit("a hire was read")).cast(f.dataType).alias(f.name) for f in schema
    ]))
    reports.hires_enriched(fact, departments, jobs, **limits)
    reports.hires_by_quarter(fact, departments, jobs, 1997, **limits)
    reports.departments_above_mean(fact, departments, 1997, **limits)
    with pytest.raises(Exception, match="a hire was read"):
        reports.hires_by_quarter(fact, departments, jobs, 1997, **limits).collect()


def test_a_report_of_one_year_opens_no_other_year(spark):
    db = sample.database(spark, sample.star(spark, SF_DIR))
    refine(spark, db)
    refined = [spark.table(f"{db}.{t}_refined") for t in ("hired_employees", "departments", "jobs")]
    report = reports.hires_by_quarter(*refined, 1997)
    assert "PartitionFilters: [hire_year" in plan_of(report, run=False)
    expected = rows(report)
    folder = tables.location_of(spark, f"{db}.hired_employees_refined").removeprefix("file:")
    years = sorted(p.name for p in pathlib.Path(folder).glob("hire_year=*"))
    assert len(years) > 5 and "hire_year=__HIVE_DEFAULT_PARTITION__" in years
    for path in pathlib.Path(folder).glob("hire_year=*/*.parquet"):
        if path.parent.name != "hire_year=1997":
            path.write_bytes(b"no parquet")
    for fact in (refined[0], spark.read.schema(refined[0].schema).parquet(folder)):
        for on_bad_date in ("raise", "null"):
            assert rows(reports.hires_by_quarter(fact, *refined[1:], 1997, on_bad_date)) == expected


def test_refined_files_are_few_and_ordered(spark):
    db = sample.database(spark, sample.star(spark, SF_DIR))
    refine(spark, db)
    refined = spark.table(f"{db}.hired_employees_refined")
    per_year = refined.select("hire_year", F.input_file_name().alias("file")).distinct().groupBy("hire_year").count()
    assert {r["count"] for r in per_year.collect()} == {1}


def test_a_bad_date_of_any_year_still_fails_a_report(spark, star):
    fact, dep, jobs = star([("2021-02-03", 1, 1), ("0", 1, 1), ("x", 1, 1)])
    db = sample.database(spark, {"hired_employees": fact, "departments": dep, "jobs": jobs})
    refine(spark, db)
    with pytest.raises(Exception, match="no date"):
        reports.summarise_year(spark, db, 2021)
    assert rows(reports.summarise_year(spark, db, 2021, "null")) == [("Sales", "Clerk", 1, 0, 0, 0)]


def test_refine_asks_for_as_many_partitions_as_its_input_needs(spark, conf, monkeypatch):
    """A table of 1 TB, with the settings that a session has by default."""
    conf(spark__sql__shuffle__partitions=200)
    db = sample.database(spark, sample.star(spark, SF_DIR))
    plans, replace = [], tables.replace_table
    monkeypatch.setattr(refining, "bytes_of_plan", lambda df: 1 << 40)
    monkeypatch.setattr(
        tables, "replace_table", lambda df, *args: (plans.append(plan_of(df, run=False)), replace(df, *args))
    )
    refine(spark, db, ["departments"])
    assert "hashpartitioning(id" in plans[0] and ", 4096)" in plans[0]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"


def test_the_size_of_a_plan_is_that_of_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).repartition(3).write.parquet(path)
    size = sum(p.stat().st_size for p in pathlib.Path(path).glob("*.parquet"))
    assert size / 2 < bytes_of_plan(spark.read.parquet(path)) < size * 2


@pytest.mark.parametrize("header", [False, True])
def test_declared_csv_is_lazy_and_read_once(spark, tmp_path, header):
    (tmp_path / "a.csv").write_text('1,a\n2,"b\n')
    (tmp_path / "b.csv").write_text("id,job\nx,c\n")
    found = csv.read_declared(spark, str(tmp_path), table_schema("jobs"), header)
    plan = plan_of(found, run=False)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    with pytest.raises(Exception, match="does not close|MALFORMED"):
        found.collect()


def test_normalising_reads_each_file_once(spark, tmp_path):
    schema = history_schema(table_schema("jobs"))
    (tmp_path / "jobs.csv").write_text("id,job\n1,a\n")
    rows_of = normalise_history(csv.read_declared(spark, str(tmp_path), schema, True))
    plan = plan_of(rows_of, run=False)
    assert plan.count("FileScan") == 1 and plan.count("from_csv") == 1
    assert rows(rows_of) == [(1, "a")]
