"""Session settings for local runs, and the shared folder for written state."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .sources.files import remove_folder


# A reduce task's share of a shuffle, and the most tasks worth having.
SHUFFLE_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000


def settings_for(input_bytes: int) -> dict[str, str]:
    """Session settings for jobs that shuffle a whole table of this size.

    Adaptive execution merges small partitions but never adds any, so the number
    to start from has to follow the data.
    """
    partitions = min(max(math.ceil(input_bytes / SHUFFLE_BYTES), 200), MAX_SHUFFLE_PARTITIONS)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_BYTES),
    }


def own_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session with the caller's cluster, catalog and settings, but for those given.

    A job that needs other settings runs in one of these: the caller's session,
    and jobs that run in it at the same time, keep theirs.
    """
    own = spark.newSession()
    known = own.conf.getAll
    for key, value in spark.conf.getAll.items():
        if known.get(key) != value and own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key.replace("__", "."), value)
    return own


def bytes_of_plan(df: DataFrame) -> int:
    """What the optimizer expects a frame to hold, from the statistics of its scans."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session whose shuffles have a partition for each share of this input.

    It is the caller's if that asks for as many, and one of its own if not.
    """
    if math.ceil(input_bytes / SHUFFLE_BYTES) <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return spark
    wanted = settings_for(input_bytes)["spark.sql.shuffle.partitions"]
    return own_session(spark, spark__sql__shuffle__partitions=wanted)


def local_session(cpus: int | str = "*", partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rollcall")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="rollcall-")
    return f"{base.rstrip('/')}/rollcall/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def written(df: DataFrame, purpose: str, reader: SparkSession | None = None) -> Iterator[DataFrame]:
    """The rows of ``df`` from a folder they are written to once.

    For a job that uses costly rows several times: what is written survives the
    loss of executors. The folder is removed at the end of the job. Another
    session may read the rows than the one that makes them.
    """
    spark = reader or df.sparkSession
    path = run_dir(spark, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
