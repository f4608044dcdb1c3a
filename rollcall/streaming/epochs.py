"""Epochs of streams: appended to a table once each, with a record of what they brought.

An epoch is known by the id of its stream (kept in the checkpoint) and its
number. Its record is a small file that appears as a whole once its rows are in.
An epoch that has a record is not appended again. One that was interrupted has
files in the table that bear its name, and no record: they are removed before it
is written anew. So each epoch is in the table once, however often it is run.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import own_session
from ..sources import files, tables

RECORD = "rows BIGINT, rows_refused BIGINT, rows_left_out BIGINT, stream STRING, epoch BIGINT"
COUNTS = ["rows", "rows_refused", "rows_left_out"]
# Spark's writers begin the names of their files with this Hadoop setting.
FILE_NAMES = "mapreduce.output.basename"
# Whether a job ends with a file _SUCCESS: of epochs, the records tell.
MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
# How Spark keeps the files of a stream's checkpoint, and for how long those it has merged.
MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
CLEANUP = "spark.sql.streaming.fileSource.log.cleanupDelay"
LOCAL = {MANAGER: BY_FILE_SYSTEM, CLEANUP: "0"}


def session_for(spark: SparkSession, checkpoint_dir: str, scans: SparkSession | None = None) -> SparkSession:
    """The session that a stream is started from: the caller's, or that which ``scans`` its files.

    Spark notes an epoch's begin and end in files that it renames. In a local file
    system its usual way asks for links by starting programs, some 50 ms an epoch; there
    it shall rename by the other of its two ways, in a session of the stream's own.
    It also lists its notes of the files seen in each epoch, those of the last ten
    minutes and more: there they need not wait. A caller's choice is kept.
    """
    scans = scans or spark
    chosen = {key: spark.conf.get(key, None) for key in LOCAL}
    if files.is_local(spark, checkpoint_dir):
        chosen = {key: LOCAL[key] if value is None else value for key, value in chosen.items()}
    to_set = {k: v for k, v in chosen.items() if v is not None and scans.conf.get(k, None) != v}
    return own_session(scans, **to_set) if to_set else scans


def stream_of(batch: DataFrame) -> str:
    """The id of the stream that a batch belongs to, the same after a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def records_of(spark: SparkSession, db: str, table: str) -> str:
    """Where the records of a table are: beside its versions, so they outlive a replacement."""
    return f"{tables.database_folder(spark, db)}/_rollcall/epochs/{table.lower()}"


def _record(folder: str, stream: str, epoch: int) -> str:
    return f"{folder.rstrip('/')}/stream={stream}/epoch={epoch}/counts.json"


def is_recorded(spark: SparkSession, folder: str, stream: str, epoch: int) -> bool:
    return files.exists(spark, _record(folder, stream, epoch))


def put_record(spark: SparkSession, folder: str, stream: str, epoch: int, counts: dict[str, int]) -> None:
    text = json.dumps({key: counts[key] for key in COUNTS})
    files.put_file(spark, _record(folder, stream, epoch), text + "\n")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """stream, epoch, rows, rows_refused and rows_left_out of all epochs."""
    if not files.exists(spark, folder):
        return spark.createDataFrame([], RECORD).select("stream", "epoch", *COUNTS)
    return spark.read.schema(RECORD).json(folder).select("stream", "epoch", *COUNTS)


def epochs_of(spark: SparkSession, db: str, table: str) -> DataFrame:
    """What each epoch of each stream has brought to a table."""
    return read_records(spark, records_of(spark, db, table))


def append_epoch(
    spark: SparkSession,
    rows: DataFrame,
    schema: T.StructType,
    db: str,
    table: str,
    stream: str,
    epoch: int,
    may_be_there: bool = True,
) -> None:
    """Write the rows of an epoch to its table, in place of those of an interrupted try.

    The record is put by the caller afterwards. If the table is replaced
    meanwhile, the rows are written to the new version as well. The table's files
    are listed only if such a try ``may_be_there``.
    """
    name = tables.ensure_table(spark, schema, db, table)
    entry = tables.stored(spark, name)
    columns = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema)
    if entry.columns != f"struct<{columns}>" or entry.partitions or entry.provider != "parquet":
        raise ValueError(f"{name} is no plain Parquet table with the columns {columns}")
    begin = f"epoch-{stream}-{epoch}"
    rows = rows.selectExpr(*[f"`{c}`" for c in schema.names])
    folder, location = None, entry.location
    while folder != location:
        folder = location
        if may_be_there:
            for path in files.files_like(spark, folder, f"{begin}-"):
                files.remove_folder(spark, path)
        rows.write.mode("append").options(**{FILE_NAMES: begin, MARKER: "false"}).parquet(folder)
        # A version that is pointed to again has these rows.
        location, may_be_there = tables.location_of(spark, name), True
    # The write has refreshed cached frames that read this folder.
    tables.forget_files(spark, name)
