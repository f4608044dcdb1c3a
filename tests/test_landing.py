import json

import pytest
from pyspark.sql.types import StructType

from helpers import rows
from rollcall.operators.file_head import block_heads, cap_files, one_block_a_task, with_position
from rollcall.plans.landing import append_capped_csv, append_records
from rollcall.sources import csv, tables

JOBS = StructType().add("id", "long").add("job", "string")


def put(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))


def table(spark, db, name="jobs"):
    return spark.table(tables.table_name(db, name))


def report_of(df):
    return {r.table: (r.status, r.rows) for r in df.collect()}


def heads_of(spark, path, n):
    return block_heads(with_position(csv.read_lines(one_block_a_task(spark), path)), n)


def test_first_rows_of_each_file_over_many_blocks(spark, tmp_path, conf):
    for name in "ab":
        put(tmp_path / f"{name}.csv", (f"{i},job {name}{i}" for i in range(3000)))
    for size in (2_000, 30_000, 10_000_000):
        conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=0)
        lines = csv.read_lines(one_block_a_task(spark), str(tmp_path))
        blocks = lines.select("_file", "_block").distinct().count()
        assert blocks > 20 if size == 2_000 else blocks >= 2
        heads = heads_of(spark, str(tmp_path), 1000)
        kept = csv.parse_lines(cap_files(heads, 1000), JOBS).collect()
        expected = [(str(i), f"job {name}{i}", i + 1) for name in "ab" for i in range(1000)]
        assert sorted((r.id, r.job, r._row) for r in kept) == sorted(expected)


def test_many_small_files_have_a_task_each(spark, tmp_path, conf):
    conf(spark__sql__files__openCostInBytes=0, spark__sql__files__maxPartitionNum=1)
    for i in range(40):
        put(tmp_path / f"{i}.csv", [f"{k},j" for k in range(i % 4)])
    heads = heads_of(spark, str(tmp_path), 2)
    assert heads.groupBy("_file").count().filter("count > 2").isEmpty()
    assert heads.count() == sum(min(i % 4, 2) for i in range(40))


@pytest.mark.parametrize("n", [10, 50_000])
def test_blocks_are_cut_where_they_are_read_whatever_the_cap(spark, tmp_path, conf, n):
    put(tmp_path / "jobs.csv", (f"{i},j" for i in range(5000)))
    conf(spark__sql__files__maxPartitionBytes=4_000)
    heads = heads_of(spark, str(tmp_path), n)
    plan = heads._jdf.queryExecution().executedPlan().toString()
    for word in ("Sort", "Exchange", "Window"):
        assert word not in plan
    assert plan.count("FileScan") == 1 and f"<= {n}" in plan
    kept = csv.parse_lines(cap_files(heads, n), JOBS)
    assert sorted(int(r.id) for r in kept.collect()) == list(range(min(n, 5000)))


def test_landed_files_are_read_once(spark, tmp_path, db):
    """Lines beyond the cap are counted by the scan that takes the first ones."""
    put(tmp_path / "jobs.csv", (f"{i},j" for i in range(50)))
    reads = spark.sparkContext.accumulator(0)
    read_lines = csv.read_lines

    def counted(*args):
        reads.add(1)
        return read_lines(*args)

    csv.read_lines = counted
    try:
        done = append_capped_csv(spark, str(tmp_path), db, max_rows=20).first()
    finally:
        csv.read_lines = read_lines
    assert (done.rows, done.rows_left_out, reads.value) == (20, 30, 1)


def test_an_empty_folder_appends_nothing(spark, tmp_path, db):
    (tmp_path / "jobs.csv").mkdir()
    done = append_capped_csv(spark, str(tmp_path), db).first()
    assert (done.status, done.rows, done.rows_refused, done.rows_left_out) == ("ok", 0, 0, 0)


def test_no_setting_differs_after_a_job(spark, tmp_path, db):
    put(tmp_path / "jobs.csv", ["1,a"])
    before = spark.conf.getAll
    append_capped_csv(spark, str(tmp_path), db, max_rows=50_000)
    assert spark.conf.getAll == before


def test_rows_beyond_the_bound_are_counted(spark, tmp_path, db):
    put(tmp_path / "a" / "jobs.csv" / "1.csv", (f"{i},j" for i in range(10)))
    put(tmp_path / "a" / "jobs.csv" / "2.csv", ["x,j"] * 5)
    done = append_capped_csv(spark, str(tmp_path / "a"), db, max_rows=4).first()
    assert (done.status, done.rows, done.rows_refused, done.rows_left_out) == ("partial", 4, 4, 7)
    good = [json.dumps({"id": i, "job": "j"}) for i in range(5000)]
    put(tmp_path / "b" / "a.json", [*good, "{no"])
    done = append_records(spark, str(tmp_path / "b"), db, "jobs").first()
    assert (done.status, done.rows, done.rows_refused, done.rows_left_out) == ("partial", 5000, 1, 0)
    done = append_records(spark, str(tmp_path / "b"), db, "jobs", max_rows=100).first()
    assert (done.rows, done.rows_refused, done.rows_left_out) == (100, 1, 4900)


def test_a_refused_batch_is_an_error(spark, tmp_path, db):
    put(tmp_path / "a" / "jobs.csv", ["x,j"])
    put(tmp_path / "b" / "a.json", ["{no"])
    assert append_capped_csv(spark, str(tmp_path / "a"), db).first().status == "error"
    assert append_records(spark, str(tmp_path / "b"), db, "jobs").first().status == "error"


def test_rejects_that_cannot_be_kept_append_nothing(spark, tmp_path, db):
    put(tmp_path / "a" / "jobs.csv" / "1.csv", ["1,a"])
    put(tmp_path / "a" / "jobs.csv" / "2.csv", ["x,a"])
    put(tmp_path / "b" / "a.json", [json.dumps({"id": 1, "job": "a"}), "{no"])
    (tmp_path / "file").write_text("in the way")
    blocked = str(tmp_path / "file")
    assert append_capped_csv(spark, str(tmp_path / "a"), db, rejects_dir=blocked).first().status == "error"
    assert append_records(spark, str(tmp_path / "b"), db, "jobs", rejects_dir=blocked).first().status == "error"
    assert not spark.catalog.tableExists(tables.table_name(db, "jobs")) or table(spark, db).count() == 0


def test_an_open_quote_is_refused(spark, tmp_path, db):
    put(tmp_path / "jobs.csv", ['1,"x', '2,y"'])
    assert append_capped_csv(spark, str(tmp_path), db).first().status == "error"


def test_append_capped(spark, tmp_path, db):
    put(tmp_path / "jobs.csv" / "x" / "1.csv", (f"{i},one" for i in range(5)))
    put(tmp_path / "jobs.csv" / "2.csv", (f"{i},two" for i in range(2)))
    put(tmp_path / "jobs.csv" / "notes.txt", ["not data"])
    put(tmp_path / "departments.csv", ["1,Law"])
    put(tmp_path / "people.csv", ["1,Ann"])
    put(tmp_path / "readme.txt", ["not data"])
    done = report_of(append_capped_csv(spark, str(tmp_path), db, max_rows=3))
    assert done == {"jobs": ("ok", 5), "departments": ("ok", 1), "people": ("skipped", None)}
    assert rows(table(spark, db)) == [
        (0, "one"), (0, "two"), (1, "one"), (1, "two"), (2, "one"),
    ]
    append_capped_csv(spark, str(tmp_path), db, max_rows=3)
    assert table(spark, db).count() == 10


@pytest.mark.parametrize("bad", ["x,job", ",job", "1.5,job", "7", "7,job,more", "id,job"])
def test_a_row_that_does_not_fit_refuses_its_file_only(spark, tmp_path, db, bad):
    put(tmp_path / "in" / "jobs.csv" / "bad.csv", ["1,fine", bad, "2,fine"])
    put(tmp_path / "in" / "jobs.csv" / "good.csv", ["3,fine", "4,"])
    rejects = str(tmp_path / "rejects")
    report = append_capped_csv(spark, str(tmp_path / "in"), db, rejects_dir=rejects)
    assert report_of(report) == {"jobs": ("partial", 2)}
    assert report.first().message == "files rejected: 1"
    assert (report.first().rows_refused, report.first().rows_left_out) == (3, 0)
    assert rows(table(spark, db)) == [(3, "fine"), (4, "")]
    assert spark.read.parquet(f"{rejects}/jobs").count() == 3


def test_a_bad_row_after_the_cap_is_never_looked_at(spark, tmp_path, db):
    put(tmp_path / "jobs.csv", ["1,a", "2,b", "x,c"])
    assert report_of(append_capped_csv(spark, str(tmp_path), db, max_rows=2)) == {"jobs": ("ok", 2)}


def test_quoted_text_survives(spark, tmp_path, db):
    put(tmp_path / "jobs.csv", ['1,"a, ""b"""', "2,  c  "])
    append_capped_csv(spark, str(tmp_path), db)
    assert rows(table(spark, db)) == [(1, 'a, "b"'), (2, "  c  ")]


RECORDS = [
    json.dumps({"id": 1, "department": "Human Resources"}),
    json.dumps({"id": "2", "department": "Law", "extra": True}),
    json.dumps({"department": "no id"}),
    json.dumps({"id": "abc", "department": "word"}),
    json.dumps({"id": 1.5, "department": "fraction"}),
    json.dumps({"id": 1.0, "department": "float"}),
    json.dumps({"id": 3, "department": None}),
    "{not json}",
    json.dumps({"id": 4, "department": {"name": "object"}}),
    json.dumps({"id": 5, "department": ["list"]}),
    json.dumps([{"id": 6, "department": "record in a list"}]),
    json.dumps({"id": 7, "department": "[text] {like} one"}),
    json.dumps({"id": 8, "department": '{"quoted": "object"}'}),
    json.dumps({"id": 9, "department": 10}),
]


def test_append_records(spark, tmp_path, db):
    put(tmp_path / "in" / "a.json", RECORDS)
    rejects = str(tmp_path / "rejects")
    done = append_records(spark, str(tmp_path / "in"), db, "departments", rejects_dir=rejects)
    assert report_of(done) == {"departments": ("partial", 5)}
    assert (done.first().rows_refused, done.first().rows_left_out) == (9, 0)
    assert rows(table(spark, db, "departments")) == [
        (1, "Human Resources"), (2, "Law"), (7, "[text] {like} one"),
        (8, '{"quoted": "object"}'), (9, "10"),
    ]
    refused = spark.read.parquet(rejects)
    assert sorted(r._record for r in refused.collect()) == sorted(RECORDS[2:11])


def test_record_cap_counts_accepted_records_per_file(spark, tmp_path, db):
    good = [json.dumps({"id": i, "job": f"j{i}"}) for i in range(10)]
    put(tmp_path / "a.json", ["{bad", *good])
    put(tmp_path / "b.json", good[:2])
    assert report_of(append_records(spark, str(tmp_path), db, "jobs", max_rows=4)) == {
        "jobs": ("partial", 6)
    }
    assert sorted(r.id for r in table(spark, db).collect()) == [0, 0, 1, 1, 2, 3]


def test_missing_folder_is_reported(spark, tmp_path, db):
    report = append_records(spark, str(tmp_path / "none"), db, "jobs").collect()
    assert [(r.status, r.rows) for r in report] == [("error", None)]


def test_written_folders_are_removed(spark, tmp_path, db):
    import pathlib

    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "rollcall"
    before = {p.name for p in shared.iterdir()}
    put(tmp_path / "jobs.csv", ["1,a"])
    append_capped_csv(spark, str(tmp_path), db)
    assert {p.name for p in shared.iterdir()} == before
