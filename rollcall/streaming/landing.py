"""The two landing paths as streams that read each file once.

Rows land in a table, or in a folder of their own. In a table each micro-batch
(epoch) is committed once, see :mod:`.epochs`. In a folder it writes its own
``stream=id/epoch=n`` and overwrites it if the batch is run again after a
failure. The id is kept in the checkpoint: streams with checkpoints of their own,
and a stream whose checkpoint is renewed, do not meet. Either way every row lands
exactly once, and each epoch has a record of the rows that landed, those that
were refused, and those beyond a bound.

A stream ends when it has read the files that are there, or with
``every="1 minute"`` looks for new ones until it is stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.file_head import blocks_of, gathered_files, one_block_a_task
from ..plans.landing import (
    MAX_ROWS,
    bounded_records,
    capped_lines,
    checked_records,
    line_heads,
    refused_records,
    typed,
    whole_lines,
)
from ..schemas import table_schema
from ..session import written
from ..sources import csv, records
from . import epochs

FILES_PER_BATCH = 10_000
# If an epoch's blocks can keep no more lines than this, a file's are gathered in one task.
GATHERED_ROWS = 1_000_000
# Where the records of a folder's epochs are.
RECORDS = "_epochs"


class _Sink:
    """Where the accepted and the refused rows of an epoch go."""

    def __init__(self, spark: SparkSession, table: str, rejects_dir: str | None):
        self.spark, self.table, self.rejects_dir = spark, table, rejects_dir
        self.schema = table_schema(table)

    def records(self) -> str:
        raise NotImplementedError

    def put_rows(self, rows: DataFrame, stream: str, epoch: int) -> None:
        raise NotImplementedError

    def is_done(self, stream: str, epoch: int) -> bool:
        return False

    def put(self, rows: DataFrame, refused: DataFrame | None, stream: str, epoch: int, counts: Callable[[], dict]) -> None:
        # Rejects first: if they cannot be kept, nothing has landed.
        if self.rejects_dir:
            _land(refused, self.rejects_dir, stream, epoch)
        self.put_rows(rows, stream, epoch)
        epochs.put_record(self.spark, self.records(), stream, epoch, counts())


class _FolderSink(_Sink):
    def __init__(self, spark, table, rejects_dir, landed_dir: str):
        super().__init__(spark, table, rejects_dir)
        self.landed_dir = landed_dir

    def records(self) -> str:
        return f"{self.landed_dir.rstrip('/')}/{RECORDS}"

    def put_rows(self, rows, stream, epoch):
        _land(rows.selectExpr(*[f"`{c}`" for c in self.schema.names]), self.landed_dir, stream, epoch)


class _TableSink(_Sink):
    def __init__(self, spark, table, rejects_dir, db: str):
        super().__init__(spark, table, rejects_dir)
        self.db = db
        # A run ends with the first epoch that fails: only the first it writes may
        # have been tried before, by an earlier run.
        self.first = True

    def records(self) -> str:
        return epochs.records_of(self.spark, self.db, self.table)

    def is_done(self, stream, epoch):
        return epochs.is_recorded(self.spark, self.records(), stream, epoch)

    def put_rows(self, rows, stream, epoch):
        epochs.append_epoch(self.spark, rows, self.schema, self.db, self.table, stream, epoch, self.first)
        self.first = False


def _land(df: DataFrame, folder: str, stream: str, epoch: int) -> None:
    path = f"{folder.rstrip('/')}/stream={stream}/epoch={epoch}"
    df.write.mode("overwrite").option(epochs.MARKER, "false").parquet(path)


def _start(rows: DataFrame, checkpoint_dir: str, sink: _Sink, write_batch, every: str | None) -> StreamingQuery:
    def write_once(batch: DataFrame, epoch: int) -> None:
        stream = epochs.stream_of(batch)
        if not sink.is_done(stream, epoch):
            write_batch(batch, stream, epoch)

    when = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.foreachBatch(write_once)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**when)
        .start()
    )


def _stream_records(spark, json_dir, sink: _Sink, checkpoint_dir, max_rows, files_per_batch, every) -> StreamingQuery:
    # Expressions are made once: each is many calls to the JVM.
    of_records = F.count_if("_ok").alias("valid"), F.count_if(~F.col("_ok")).alias("refused")

    def write_batch(batch: DataFrame, stream: str, epoch: int) -> None:
        seen = Observation()
        # Places in a file matter to a bound only, and are not known in a stream's own plan.
        rows = batch if max_rows is None else checked_records(batch, sink.schema)
        rows = rows.observe(seen, *of_records)
        if max_rows is None and not sink.rejects_dir:
            # Used once: written where they belong while they are read.
            def all_counts() -> dict:
                came = seen.get
                return dict(rows=came["valid"], rows_refused=came["refused"], rows_left_out=0)

            sink.put(rows.filter("_ok"), None, stream, epoch, all_counts)
            return
        with written(rows, "records") as checked:
            done = Observation()
            taken = checked.filter("_ok") if max_rows is None else bounded_records(checked, max_rows)

            def counts() -> dict:
                rows, came = done.get["rows"], seen.get
                return dict(rows=rows, rows_refused=came["refused"], rows_left_out=came["valid"] - rows)

            taken = taken.observe(done, F.count("*").alias("rows"))
            sink.put(taken, refused_records(checked), stream, epoch, counts)

    rows = records.stream_records(epochs.session_for(spark, checkpoint_dir), json_dir, files_per_batch)
    return _start(rows if max_rows is not None else typed(rows, sink.schema), checkpoint_dir, sink, write_batch, every)


def _stream_csv(spark, src_dir, sink: _Sink, checkpoint_dir, max_rows, files_per_batch, every) -> StreamingQuery:
    # Expressions are made once: each is many calls to the JVM.
    of_lines = F.count("*").alias("lines")
    of_heads = F.max("_block").alias("last"), F.count_if(~F.col("_ok")).alias("bad")
    of_files = F.count_if("_good").alias("rows"), F.count_if(~F.col("_good")).alias("refused")

    def write_batch(batch: DataFrame, stream: str, epoch: int) -> None:
        seen, cut, done = Observation(), Observation(), Observation()

        def counts() -> dict:
            found = done.get
            left_out = seen.get["lines"] - found["rows"] - found["refused"]
            return dict(rows=found["rows"], rows_refused=found["refused"], rows_left_out=left_out)

        lines = batch.observe(seen, of_lines)
        heads = line_heads(lines, sink.schema, max_rows)
        if not sink.rejects_dir and blocks_of(batch) * max_rows <= GATHERED_ROWS:
            # Used once: written where they belong while they are read.
            counted = gathered_files(heads, max_rows).observe(done, *of_files)
            sink.put(counted.filter("_good"), None, stream, epoch, counts)
            return
        with written(heads.observe(cut, *of_heads), "lines") as heads:
            found = cut.get
            # A block that starts beyond a file's begin may owe rows to those before it.
            if found["last"]:
                capped = capped_lines(heads, max_rows)
            else:
                capped = whole_lines(heads, found["bad"] > 0)

            refused = capped.filter("NOT _good").drop("_block", "_row", "_good")
            counted = capped.observe(done, *of_files)
            sink.put(counted.filter("_good"), refused, stream, epoch, counts)

    # The stream keeps the settings of the session it is started from.
    session = epochs.session_for(spark, checkpoint_dir, one_block_a_task(spark))
    lines = csv.stream_lines(session, src_dir, files_per_batch)
    return _start(lines, checkpoint_dir, sink, write_batch, every)


def land_records(
    spark: SparkSession,
    json_dir: str,
    table: str,
    landed_dir: str,
    checkpoint_dir: str,
    rejects_dir: str | None = None,
    max_rows: int | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    every: str | None = None,
) -> StreamingQuery:
    """Validated JSON records; ``max_rows``, if given, bounds those of one file."""
    sink = _FolderSink(spark, table, rejects_dir, landed_dir)
    return _stream_records(spark, json_dir, sink, checkpoint_dir, max_rows, files_per_batch, every)


def land_capped_csv(
    spark: SparkSession,
    src_dir: str,
    table: str,
    landed_dir: str,
    checkpoint_dir: str,
    rejects_dir: str | None = None,
    max_rows: int = MAX_ROWS,
    files_per_batch: int = FILES_PER_BATCH,
    every: str | None = None,
) -> StreamingQuery:
    """The first ``max_rows`` rows of each CSV file whose rows all fit.

    With ``rejects_dir`` the rows of the other files are kept there.
    """
    sink = _FolderSink(spark, table, rejects_dir, landed_dir)
    return _stream_csv(spark, src_dir, sink, checkpoint_dir, max_rows, files_per_batch, every)


def stream_records_into(
    spark: SparkSession,
    json_dir: str,
    db: str,
    table: str,
    checkpoint_dir: str,
    rejects_dir: str | None = None,
    max_rows: int | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    every: str | None = None,
) -> StreamingQuery:
    """Validated JSON records, appended to a table; the table is created if there is none."""
    sink = _TableSink(spark, table, rejects_dir, db)
    return _stream_records(spark, json_dir, sink, checkpoint_dir, max_rows, files_per_batch, every)


def stream_csv_into(
    spark: SparkSession,
    src_dir: str,
    db: str,
    table: str,
    checkpoint_dir: str,
    rejects_dir: str | None = None,
    max_rows: int = MAX_ROWS,
    files_per_batch: int = FILES_PER_BATCH,
    every: str | None = None,
) -> StreamingQuery:
    """The first ``max_rows`` rows of each CSV file whose rows all fit, appended to a table."""
    sink = _TableSink(spark, table, rejects_dir, db)
    return _stream_csv(spark, src_dir, sink, checkpoint_dir, max_rows, files_per_batch, every)


def read_landed(spark: SparkSession, landed_dir: str, schema: T.StructType) -> DataFrame:
    """All rows landed so far by any stream, or those kept as rejects."""
    return spark.read.schema(schema).parquet(f"{landed_dir.rstrip('/')}/stream=*/epoch=*")


def landed_counts(spark: SparkSession, landed_dir: str) -> DataFrame:
    """stream, epoch, rows, rows_refused and rows_left_out of what landed in a folder."""
    return epochs.read_records(spark, f"{landed_dir.rstrip('/')}/{RECORDS}")
