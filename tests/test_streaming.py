import json

import pytest
from pyspark.sql.types import StructType

from helpers import rows
from rollcall.operators.file_head import one_block_a_task
from rollcall.plans.refine import refine
from rollcall.sources import files, tables
from rollcall.streaming import landing
from rollcall.streaming.epochs import (
    BY_FILE_SYSTEM,
    CLEANUP,
    COUNTS,
    LOCAL,
    MANAGER,
    epochs_of,
    records_of,
    session_for,
)
from rollcall.streaming.landing import (
    land_capped_csv,
    land_records,
    landed_counts,
    read_landed,
    stream_csv_into,
    stream_records_into,
)

JOBS = StructType().add("id", "long").add("job", "string")


def put(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))


def test_records_land_once(spark, tmp_path):
    source, landed, state, rejects = (str(tmp_path / d) for d in ("in", "out", "state", "rejects"))

    def run():
        land_records(
            spark, source, "jobs", landed, state, rejects_dir=rejects, max_rows=3
        ).awaitTermination()
        return rows(read_landed(spark, landed, JOBS))

    put(tmp_path / "in" / "1.json", [json.dumps({"id": i, "job": "a"}) for i in range(5)] + ["{no"])
    first = [(0, "a"), (1, "a"), (2, "a")]
    assert run() == first
    assert run() == first
    put(tmp_path / "in" / "2.json", [json.dumps({"id": "9", "job": "b"})])
    assert run() == [*first, (9, "b")]
    assert spark.read.parquet(f"{rejects}/stream=*/epoch=*").count() == 1


def test_csv_lands_once_in_several_batches(spark, tmp_path):
    source, landed, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    for i in range(4):
        put(tmp_path / "in" / f"{i}.csv", [f"{10 * i + k},j" for k in range(5)])
    put(tmp_path / "in" / "bad.csv", ["1,j", "x,j"])
    for _ in range(2):
        land_capped_csv(
            spark, source, "jobs", landed, state, max_rows=2, files_per_batch=2
        ).awaitTermination()
        assert sorted(r.id for r in read_landed(spark, landed, JOBS).collect()) == [
            0, 1, 10, 11, 20, 21, 30, 31,
        ]
    assert len(list((tmp_path / "out").glob("stream=*/epoch=*"))) == 3


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    source, landed, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    put(tmp_path / "in" / "1.csv", ["1,a", "2,b"])

    def run():
        land_capped_csv(spark, source, "jobs", landed, state).awaitTermination()

    run()
    # As if the driver had died after the write and before the commit of the batch.
    commit = tmp_path / "state" / "commits" / "0"
    commit.rename(tmp_path / "commit-0")
    (tmp_path / "state" / "commits" / ".0.crc").rename(tmp_path / "commit-0.crc")
    run()
    assert commit.exists()
    assert rows(read_landed(spark, landed, JOBS)) == [(1, "a"), (2, "b")]


def test_landed_rows_are_refined_with_the_base_table(spark, db, tmp_path):
    source, landed, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    put(tmp_path / "in" / "1.csv", ["1,a", "2,b"])
    land_capped_csv(spark, source, "jobs", landed, state).awaitTermination()
    base = spark.createDataFrame([(2, "b"), (3, "c")], JOBS)
    tables.append_table(base, db, "jobs")
    refine(spark, db, landed_dirs={"jobs": landed})
    assert rows(spark.table(f"{db}.jobs_refined")) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_running_stream_finds_new_files(spark, tmp_path):
    source, landed, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    put(tmp_path / "in" / "1.csv", ["1,a"])
    stream = land_capped_csv(spark, source, "jobs", landed, state, every="1 second")
    try:
        stream.processAllAvailable()
        put(tmp_path / "in" / "2.csv", ["2,b"])
        stream.processAllAvailable()
    finally:
        stream.stop()
    assert rows(read_landed(spark, landed, JOBS)) == [(1, "a"), (2, "b")]


def test_refused_files_are_kept(spark, tmp_path):
    source, landed, state, rejects = (str(tmp_path / d) for d in ("in", "out", "state", "rejects"))
    put(tmp_path / "in" / "bad.csv", ["1,a", "x,b"])
    put(tmp_path / "in" / "good.csv", ["3,c"])
    land_capped_csv(spark, source, "jobs", landed, state, rejects_dir=rejects).awaitTermination()
    assert rows(read_landed(spark, landed, JOBS)) == [(3, "c")]
    assert len(read_landed(spark, rejects, JOBS).collect()) == 2


def test_streams_do_not_meet_in_one_folder(spark, tmp_path):
    landed = str(tmp_path / "out")
    for n in (1, 2, 2):  # the third run has the second's files and a checkpoint of its own
        put(tmp_path / f"in{n}" / "1.csv", [f"{n},j"])
        state = str(tmp_path / f"state{len(list(tmp_path.iterdir()))}-{n}")
        while (tmp_path / state).exists():
            state += "x"
        land_capped_csv(spark, str(tmp_path / f"in{n}"), "jobs", landed, state).awaitTermination()
    assert rows(read_landed(spark, landed, JOBS)) == [(1, "j"), (2, "j"), (2, "j")]


def forget_commit(tmp_path, epoch):
    """As if the driver had died before the stream noted that a batch is done."""
    for name in (f"{epoch}", f".{epoch}.crc"):
        (tmp_path / "state" / "commits" / name).rename(tmp_path / f"commit-{len(list(tmp_path.iterdir()))}")


def test_an_epoch_is_in_the_table_once(spark, db, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    tables.append_table(spark.createDataFrame([(0, "old")], JOBS), db, "jobs")
    put(tmp_path / "in" / "1.csv", ["1,a", "2,b"])

    def run():
        stream_csv_into(spark, source, db, "jobs", state).awaitTermination()
        return rows(spark.table(f"{db}.jobs"))

    expected = [(0, "old"), (1, "a"), (2, "b")]
    assert run() == expected and run() == expected
    # The batch runs again; its record says that its rows are in.
    forget_commit(tmp_path, 0)
    assert run() == expected
    # It runs again and has no record: it was interrupted after its rows were written.
    forget_commit(tmp_path, 0)
    folder = records_of(spark, db, "jobs")
    (record,) = [r for r in epochs_of(spark, db, "jobs").inputFiles()]
    files.remove_folder(spark, record)
    assert epochs_of(spark, db, "jobs").count() == 0 and files.exists(spark, folder)
    assert run() == expected
    assert rows(epochs_of(spark, db, "jobs"), *COUNTS) == [(2, 0, 0)]
    put(tmp_path / "in" / "2.csv", ["3,c"])
    assert run() == [*expected, (3, "c")]


def test_epochs_survive_a_replacement_of_their_table(spark, db, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    put(tmp_path / "in" / "1.csv", ["1,a"])
    stream_csv_into(spark, source, db, "jobs", state).awaitTermination()
    tables.replace_table(spark.createDataFrame([(9, "z")], JOBS), db, "jobs")
    forget_commit(tmp_path, 0)
    stream_csv_into(spark, source, db, "jobs", state).awaitTermination()
    assert rows(spark.table(f"{db}.jobs")) == [(9, "z")]


def test_epochs_say_what_they_refused_and_left_out(spark, db, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    put(tmp_path / "in" / "a.csv", [f"{i},j" for i in range(10)])
    put(tmp_path / "in" / "b.csv", ["x,j"] * 5)
    put(tmp_path / "in" / "c.csv", ["", "7,j"])
    stream_csv_into(spark, source, db, "jobs", state, max_rows=4).awaitTermination()
    assert rows(epochs_of(spark, db, "jobs"), *COUNTS) == [(5, 4, 7)]
    landed = str(tmp_path / "out")
    put(tmp_path / "json" / "a.json", [json.dumps({"id": i, "job": "j"}) for i in range(6)] + ["{no"])
    land_records(
        spark, str(tmp_path / "json"), "jobs", landed, str(tmp_path / "state2"), max_rows=4
    ).awaitTermination()
    assert rows(landed_counts(spark, landed), *COUNTS) == [(4, 1, 2)]
    assert read_landed(spark, landed, JOBS).count() == 4
    assert landed_counts(spark, str(tmp_path / "none")).count() == 0


def test_records_into_a_table_that_is_not_there_yet(spark, db, tmp_path):
    put(tmp_path / "in" / "a.json", [json.dumps({"id": i, "job": "j"}) for i in range(3)] + ["{no"])
    for n in (1, 2):  # two streams with checkpoints of their own
        stream_records_into(
            spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / f"state{n}"), rejects_dir=str(tmp_path / "no")
        ).awaitTermination()
    assert rows(spark.table(f"{db}.jobs")) == sorted([(i, "j") for i in range(3)] * 2)
    assert epochs_of(spark, db, "jobs").select("stream").distinct().count() == 2
    assert spark.read.parquet(f"{tmp_path}/no/stream=*/epoch=*").count() == 2


def test_a_table_with_other_columns_takes_no_epoch(spark, db, tmp_path):
    tables.append_table(spark.createDataFrame([(1, 2)], "id BIGINT, other BIGINT"), db, "jobs")
    put(tmp_path / "in" / "1.csv", ["1,a"])
    stream = stream_csv_into(spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / "state"))
    with pytest.raises(Exception, match="no plain Parquet table"):
        stream.awaitTermination()
    assert spark.table(f"{db}.jobs").count() == 1


@pytest.mark.parametrize("cap", [3, 50_000])
def test_a_stream_cuts_blocks_where_they_are_read(spark, db, tmp_path, conf, monkeypatch, cap):
    conf(spark__sql__files__maxPartitionBytes=2_000, spark__sql__files__openCostInBytes=0)
    put(tmp_path / "in" / "a.csv", [f"{i},j" for i in range(3000)])
    put(tmp_path / "in" / "b.csv", ["5000,j"])
    seen = []
    line_heads = landing.line_heads

    def noted(lines, schema, max_rows):
        heads = line_heads(lines, schema, max_rows)
        seen.append((heads._jdf.queryExecution().executedPlan().toString(), heads.rdd.getNumPartitions()))
        return heads

    monkeypatch.setattr(landing, "line_heads", noted)
    stream_csv_into(spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / "state"), max_rows=cap).awaitTermination()
    ids = sorted(r.id for r in spark.table(f"{db}.jobs").collect())
    assert ids == [*range(min(cap, 3000)), 5000]
    ((plan, tasks),) = seen
    assert f"<= {cap}" in plan and tasks > 10
    for word in ("Sort", "Exchange", "Window"):
        assert word not in plan


def counted(monkeypatch, module, name):
    """The calls of a function, which still does its work."""
    calls, real = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *args: calls.append(args) or real(*args))
    return calls


def test_a_run_lists_the_files_of_its_table_once(spark, db, tmp_path, monkeypatch):
    for i in range(4):
        put(tmp_path / "in" / f"{i}.csv", [f"{i},j"])
        put(tmp_path / "json" / f"{i}.json", [json.dumps({"id": 10 + i, "job": "j"})])
    calls = counted(monkeypatch, files, "files_like")
    stream_csv_into(spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / "s1"), files_per_batch=1).awaitTermination()
    stream_records_into(
        spark, str(tmp_path / "json"), db, "jobs", str(tmp_path / "s2"), files_per_batch=1
    ).awaitTermination()
    assert len(calls) == 2
    assert epochs_of(spark, db, "jobs").count() == 8
    assert sorted(r.id for r in spark.table(f"{db}.jobs").collect()) == [0, 1, 2, 3, 10, 11, 12, 13]


def test_a_later_interrupted_epoch_is_written_anew(spark, db, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")

    def run():
        stream_csv_into(spark, source, db, "jobs", state, files_per_batch=1).awaitTermination()
        return rows(spark.table(f"{db}.jobs"))

    for i in range(3):
        put(tmp_path / "in" / f"{i}.csv", [f"{i},j"])
    run()
    forget_commit(tmp_path, 2)
    (record,) = [f for f in epochs_of(spark, db, "jobs").inputFiles() if "epoch=2/" in f]
    files.remove_folder(spark, record)
    for i in (3, 4):
        put(tmp_path / "in" / f"{i}.csv", [f"{i},j"])
    assert run() == [(i, "j") for i in range(5)]
    assert rows(epochs_of(spark, db, "jobs"), *COUNTS) == [(1, 0, 0)] * 5


@pytest.mark.parametrize("bad", [False, True])
def test_files_of_one_block_are_capped_by_their_heads(spark, db, tmp_path, monkeypatch, bad):
    put(tmp_path / "in" / "a.csv", [f"{i},j" for i in range(5)])
    # Its third row does not fit; the cap keeps two.
    put(tmp_path / "in" / "b.csv", ["10,j", "11,j", "x,j"])
    put(tmp_path / "in" / "c.csv", ["20,j", "x,j"] if bad else ["20,j"])
    calls = counted(monkeypatch, landing, "capped_lines")
    no = str(tmp_path / "no")
    stream_csv_into(
        spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / "state"), rejects_dir=no, max_rows=2
    ).awaitTermination()
    assert not calls
    kept = [0, 1, 10, 11] + [20] * (not bad)
    assert sorted(r.id for r in spark.table(f"{db}.jobs").collect()) == kept
    assert rows(epochs_of(spark, db, "jobs"), *COUNTS) == [(len(kept), 2 if bad else 0, 4)]
    assert sorted(str(r.id) for r in read_landed(spark, no, JOBS).collect()) == (["20", "None"] if bad else [])


def test_records_that_are_used_once_are_written_once(spark, tmp_path, monkeypatch):
    lines = [json.dumps({"id": i, "job": "j"}) for i in range(3)] + ["{no", "", json.dumps({"id": "w", "job": "j"})]
    put(tmp_path / "in" / "a.json", lines)
    calls = counted(monkeypatch, landing, "written")
    for n, rejects in ((1, None), (2, str(tmp_path / "no"))):
        out = str(tmp_path / f"out{n}")
        land_records(
            spark, str(tmp_path / "in"), "jobs", out, str(tmp_path / f"state{n}"), rejects_dir=rejects
        ).awaitTermination()
        assert len(calls) == n - 1
        assert rows(read_landed(spark, out, JOBS)) == [(i, "j") for i in range(3)]
        assert rows(landed_counts(spark, out), *COUNTS) == [(3, 2, 0)]
    assert spark.read.parquet(f"{tmp_path}/no/stream=*/epoch=*").count() == 2


@pytest.mark.parametrize("gathered", [0, 1_000_000])
def test_files_are_capped_alike_gathered_or_by_blocks(spark, db, tmp_path, conf, monkeypatch, gathered):
    monkeypatch.setattr(landing, "GATHERED_ROWS", gathered, raising=False)
    conf(spark__sql__files__maxPartitionBytes=100, spark__sql__files__openCostInBytes=0)
    put(tmp_path / "in" / "long.csv", [f"{i},j" for i in range(100, 200)])
    # Their rows that do not fit are the last that the cap keeps, and the first beyond it.
    put(tmp_path / "in" / "bad.csv", [f"{i},j" for i in range(300, 339)] + ["x,j"] + ["1,j"] * 60)
    put(tmp_path / "in" / "good.csv", [f"{i},j" for i in range(400, 440)] + ["x,j"] + ["1,j"] * 60)
    put(tmp_path / "in" / "odd.csv", ['500,"a,b"', "501,"])
    put(tmp_path / "in" / "quote.csv", ['600,"a'])
    put(tmp_path / "in" / "empty.csv", ["", " "])
    calls = counted(monkeypatch, landing, "written")
    stream_csv_into(spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / "state"), max_rows=40).awaitTermination()
    kept = [(i, "j") for i in [*range(100, 140), *range(400, 440)]] + [(500, "a,b"), (501, "")]
    assert rows(spark.table(f"{db}.jobs")) == kept
    assert rows(epochs_of(spark, db, "jobs"), *COUNTS) == [(82, 41, 181)]
    # Lines that are used once are not written before.
    assert len(calls) == (gathered == 0)


def test_an_epoch_does_not_look_at_the_rows_of_its_table(spark, db, tmp_path, monkeypatch):
    """That lists the table's files: what an epoch costs would grow with those before it."""
    for i in range(3):
        put(tmp_path / "in" / f"{i}.csv", [f"{i},j"])
    tables.append_table(spark.createDataFrame([(9, "z")], JOBS), db, "jobs")
    cached = spark.table(f"{db}.jobs").cache()
    assert rows(spark.table(f"{db}.jobs")) == [(9, "z")]
    calls = counted(monkeypatch, tables, "columns_of")
    stream_csv_into(spark, str(tmp_path / "in"), db, "jobs", str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    assert not calls
    # The session that has read the table before sees the new rows, by a cached frame too.
    assert rows(spark.table(f"{db}.jobs")) == [(0, "j"), (1, "j"), (2, "j"), (9, "z")] == rows(cached)
    cached.unpersist()


def test_a_local_checkpoint_needs_no_programs_and_no_delay(spark, conf, tmp_path):
    """Unless the caller has chosen how; other file systems keep Spark's way."""
    state = str(tmp_path / "state")
    own = session_for(spark, state)
    assert own is not spark and {key: own.conf.get(key) for key in LOCAL} == LOCAL
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    scans = session_for(spark, state, one_block_a_task(spark))
    settings = [MANAGER, "spark.sql.files.openCostInBytes"]
    assert [scans.conf.get(s) for s in settings] == [BY_FILE_SYSTEM, spark.conf.get("spark.sql.files.maxPartitionBytes")]
    other = BY_FILE_SYSTEM.replace("FileSystemBased", "FileContextBased")
    conf(**{MANAGER: other, CLEANUP: "600000ms"})
    assert session_for(spark, state) is spark
    scans = session_for(spark, state, one_block_a_task(spark))
    assert scans.conf.get(MANAGER) == other and scans.conf.get(CLEANUP) == "600000ms"


def test_a_stream_merges_its_notes_of_files(spark, tmp_path):
    for i in range(115):
        put(tmp_path / "in" / f"{i:03}.json", [json.dumps({"id": i, "job": "j"})])
    state, landed = tmp_path / "state", str(tmp_path / "out")
    for _ in range(2):
        land_records(spark, str(tmp_path / "in"), "jobs", landed, str(state), files_per_batch=1).awaitTermination()
        put(tmp_path / "in" / "late.json", [json.dumps({"id": 115, "job": "j"})])
    assert rows(read_landed(spark, landed, JOBS)) == sorted(((i, "j") for i in range(116)), key=repr)
    assert rows(landed_counts(spark, landed), *COUNTS) == [(1, 0, 0)] * 116
    assert len(list((state / "sources" / "0").glob("[0-9]*"))) < 115
