from helpers import rows
from rollcall import sample
from rollcall.plans.history import ingest, normalise_files
from rollcall.schemas import table_schema
from rollcall.sources import csv, tables


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def report_of(df):
    return {r.table: r.status for r in df.collect()}


def test_normalise_files(spark, tmp_path):
    put(
        tmp_path / "in" / "hired_employees.csv",
        "id,name,datetime,department_id,job_id\n1,Ann,2021-01-01T00:00:00Z,3.0,\n2,,,,4\n",
    )
    put(tmp_path / "in" / "people.csv", "id\n1\n")
    spark.sql("SELECT 9007199254740993L AS id, CAST(NULL AS STRING) AS job").write.parquet(
        str(tmp_path / "in" / "jobs.parquet")
    )
    report = normalise_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert report_of(report) == {"hired_employees": "ok", "jobs": "ok", "people": "skipped"}

    def read(table):
        path = str(tmp_path / "out" / f"{table}.csv")
        return csv.read_declared(spark, path, table_schema(table))

    assert rows(read("hired_employees")) == [
        (1, "Ann", "2021-01-01T00:00:00Z", 3, 0), (2, "0", "0", 0, 4),
    ]
    assert rows(read("jobs")) == [(9007199254740993, "0")]


def test_ingest_keeps_going_and_keeps_the_old_table(spark, tmp_path, db):
    raw_db = sample.database(spark, {})
    put(tmp_path / "jobs.csv", "1,Clerk\n1,Clerk\n2,Lead\n")
    put(tmp_path / "departments.csv", "1,Law\n")
    assert set(report_of(ingest(spark, str(tmp_path), db, raw_db)).values()) == {"ok"}
    assert rows(spark.table(f"{db}.jobs")) == [(1, "Clerk"), (2, "Lead")]

    # A header line is data here, and no integer.
    put(tmp_path / "jobs.csv", "id,job\n3,Cook\n")
    put(tmp_path / "departments.csv", "2,Tax\n")
    put(tmp_path / "people.csv", "1,Ann\n")
    assert report_of(ingest(spark, str(tmp_path), db, raw_db)) == {
        "jobs_raw": "ok", "jobs": "error",
        "departments_raw": "ok", "departments": "ok",
        "people": "skipped",
    }
    assert rows(spark.table(f"{db}.jobs")) == [(1, "Clerk"), (2, "Lead")]
    assert rows(spark.table(f"{db}.departments")) == [(2, "Tax")]
    assert tables.list_tables(spark, db) == ["departments", "jobs"]

    report = report_of(ingest(spark, str(tmp_path), db, raw_db, header=True))
    assert report["jobs"] == "ok"
    assert rows(spark.table(f"{db}.jobs")) == [(3, "Cook")]


def test_no_base_table_from_a_failed_raw_table(spark, tmp_path, db):
    put(tmp_path / "jobs.csv", "1,Clerk\n")
    report = ingest(spark, str(tmp_path), db, "no_such_database")
    assert report_of(report) == {"jobs_raw": "error", "jobs": "skipped"}


def test_raw_table_is_read_when_queried(spark, tmp_path, db):
    put(tmp_path / "jobs.csv" / "1.csv", "1,Clerk\n")
    csv.create_raw_table(spark, f"{db}.r", str(tmp_path / "jobs.csv"), table_schema("jobs"))
    put(tmp_path / "jobs.csv" / "2.csv", "2,Lead\n")
    spark.catalog.refreshTable(f"{db}.r")
    assert rows(spark.table(f"{db}.r")) == [(1, "Clerk"), (2, "Lead")]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    texts = ['a "b", c', " padded ", "back\\slash", "0"]
    df = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, job STRING")
    for header in (False, True):
        path = str(tmp_path / f"{header}.csv")
        csv.write(df, path, header)
        assert rows(csv.read_declared(spark, path, table_schema("jobs"), header)) == rows(df)


def test_an_open_quote_is_refused(spark, tmp_path):
    (tmp_path / "jobs.csv").write_text('1,"x\n2,y"\n')
    db, raw = sample.database(spark, {}), sample.database(spark, {})
    report = {r.table: r.status for r in ingest(spark, str(tmp_path), db, raw).collect()}
    assert report == {"jobs_raw": "error", "jobs": "skipped"}
