"""Tables of a catalog database: list, replace, append.

A table that is replaced has its files in a version of its own, a folder below
``{table}.versions`` in the database's folder. The catalog entry points to one of
them. A replacement writes a new version and then moves the pointer: nothing is
renamed or copied, and at every moment the table is the old one or the new one.
The version before stays until the next replacement, for those who still read it.

Writers share nothing while they write. To move the pointer a writer takes the
table's lease, a file that names it and the time when its turn is over; another
one waits, and takes a turn that is over. Listings only read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import files
from ..session import own_session

# Name of a table that takes the place of one with other columns; no other may end like this.
NEXT = "__rollcall_next"
VERSIONS = ".versions"
RETIRED = "_retired"
LEASE = "_lease"
# How long a writer may take to move a pointer, and how long another waits for its turn.
LEASE_SECONDS = 300
WAIT_SECONDS = 600
# Versions that were never pointed to are taken for abandoned after this time.
ABANDONED_SECONDS = 7 * 24 * 3600


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def table_name(db: str, table: str) -> str:
    return f"{db}.`{table}`"


def database_folder(spark: SparkSession, db: str) -> str:
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def list_tables(spark: SparkSession, db: str) -> list[str]:
    """Names of the stored tables of a database, temporary views left out."""
    return sorted(
        t.name
        for t in spark.catalog.listTables(db)
        if t.tableType in ("MANAGED", "EXTERNAL") and not t.name.endswith(NEXT)
    )


def location_of(spark: SparkSession, name: str) -> str:
    """The folder that a stored table points to."""
    return stored(spark, name).location


def columns_of(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema]


def described(spark: SparkSession, name: str) -> dict:
    """What the catalog says of a table."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").collect()[0][0])


@dataclass(frozen=True)
class Stored:
    """A table's entry in the catalog; reading it lists no file and runs no query."""

    location: str
    columns: str
    partitions: int
    provider: str | None


def stored(spark: SparkSession, name: str) -> Stored:
    state = spark._jsparkSession.sessionState()
    entry = state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(name))
    provider = entry.provider()
    return Stored(
        files.path_text(spark, entry.location()).rstrip("/"),
        entry.schema().catalogString(),
        entry.partitionColumnNames().size(),
        provider.get() if provider.isDefined() else None,
    )


def forget_files(spark: SparkSession, name: str) -> None:
    """Let the session list a table's files anew when it reads the table again.

    ``refreshTable`` lists them at once, twice: too much for those who only write.
    """
    state = spark._jsparkSession.sessionState()
    state.catalog().refreshTable(state.sqlParser().parseTableIdentifier(name))


def _versions(spark: SparkSession, db: str, table: str) -> str:
    return f"{database_folder(spark, db)}/{table.lower()}{VERSIONS}"


@contextmanager
def lease(spark: SparkSession, folder: str, owner: str, wait: float = WAIT_SECONDS) -> Iterator[None]:
    """Be the only one that moves the pointer of a table, for a while.

    A lease whose time is over was left by a writer that died; it is taken over.
    """
    path, until = f"{folder}/{LEASE}", time.time() + wait
    while not files.create_file(spark, path, json.dumps({"owner": owner, "until": time.time() + LEASE_SECONDS})):
        held = files.read_file(spark, path)
        try:
            over = json.loads(held)["until"] < time.time() if held is not None else False
        except ValueError:
            # Being written, or left half written: as old as the file is.
            over = files.age_of(spark, path) > LEASE_SECONDS
        if over and files.read_file(spark, path) == held:
            files.remove_folder(spark, path)
            continue
        if time.time() > until:
            raise TimeoutError(f"another writer holds {path}: {held}")
        time.sleep(0.2)
    try:
        yield
    finally:
        held = files.read_file(spark, path)
        if held and json.loads(held)["owner"] == owner:
            files.remove_folder(spark, path)


@dataclass
class Staged:
    """A version that is written and that no table points to yet."""

    spark: SparkSession
    db: str
    table: str
    path: str
    schema: T.StructType
    partitions: tuple[str, ...]

    def publish(self) -> None:
        """Point the table to this version; the one before is kept, older ones go."""
        spark, name = self.spark, table_name(self.db, self.table)
        folder = _versions(spark, self.db, self.table)
        with lease(spark, folder, self.path):
            _finish(spark, self.db, self.table)
            before = location_of(spark, name) if spark.catalog.tableExists(name) else None
            if before is not None and self._fits(name):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{self.path}'")
            else:
                self._create(before is not None)
            spark.catalog.refreshTable(name)
            self._clean(folder, before)

    def discard(self) -> None:
        files.remove_folder(self.spark, self.path)

    def _fits(self, name: str) -> bool:
        """Whether the catalog entry can point to this version as it is."""
        entry = described(self.spark, name)
        return (
            columns_of(self.spark, name) == [(f.name, f.dataType.simpleString()) for f in self.schema]
            and tuple(entry.get("partition_columns") or ()) == self.partitions
            and (entry["type"], entry["provider"]) == ("EXTERNAL", "parquet")
        )

    def _create(self, replaces: bool) -> None:
        """A new catalog entry. One with other columns takes the old one's name once it is there."""
        target = self.table + NEXT if replaces else self.table
        staged, name = table_name(self.db, target), table_name(self.db, self.table)
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        divided = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in self.partitions)})" if self.partitions else ""
        spark = self.spark
        if self.partitions:
            # They are found in the folder, so that the pointer says all there is to know.
            spark = own_session(spark, spark__sql__hive__manageFilesourcePartitions="false")
        spark.sql(f"CREATE TABLE {staged} ({columns}) USING parquet{divided} LOCATION '{self.path}'")
        if replaces:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")

    def _clean(self, folder: str, before: str | None) -> None:
        spark, current = self.spark, self.path.rsplit("/", 1)[1]
        old = before.rsplit("/", 1)[1] if before and before.rsplit("/", 2)[1] == folder.rsplit("/", 1)[1] else None
        for version in files.folders_in(spark, folder):
            path = f"{folder}/{version}"
            if version in (current, old):
                continue
            if files.exists(spark, f"{path}/{RETIRED}") or files.age_of(spark, path) > ABANDONED_SECONDS:
                files.remove_folder(spark, path)
        if old and old != current:
            files.create_file(spark, f"{folder}/{old}/{RETIRED}", "")


def _finish(spark: SparkSession, db: str, table: str) -> None:
    name, staged = table_name(db, table), table_name(db, table + NEXT)
    if spark.catalog.tableExists(staged) and not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")


def finish_replacement(spark: SparkSession, db: str, table: str) -> None:
    """Give a table its name whose writer died while it exchanged the catalog entry.

    The next replacement does so as well. Waits for the writer's turn to be over.
    """
    with lease(spark, _versions(spark, db, table), uuid.uuid4().hex):
        _finish(spark, db, table)


def stage_table(
    df: DataFrame, db: str, table: str, partitions: Sequence[str] = (), spark: SparkSession | None = None
) -> Staged:
    """Write the rows of ``df`` as a version of a table, without showing them yet.

    ``spark`` is the session that will read the table, if not that of ``df``.
    """
    if table.endswith(NEXT):
        raise ValueError(f"reserved table name: {table}")
    spark = spark or df.sparkSession
    path = f"{_versions(spark, db, table)}/v-{uuid.uuid4().hex}"
    # Partition columns come last, as the catalog has them.
    df = df.select(*[f"`{c}`" for c in df.columns if c not in partitions], *partitions)
    try:
        df.write.partitionBy(*partitions).parquet(path)
    except Exception:
        files.remove_folder(spark, path)
        raise
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return Staged(spark, db, table, path, nullable, tuple(partitions))


def replace_table(
    df: DataFrame, db: str, table: str, partitions: Sequence[str] = (), spark: SparkSession | None = None
) -> None:
    """Create or replace a table as the rows of ``df``, which may read the table it replaces.

    A failed job leaves the old table as it was. Of two writers at once the last
    to finish stays. Columns may differ from the old table's: then the entry
    itself is exchanged, and for a moment there is none.
    """
    stage_table(df, db, table, partitions, spark).publish()


def ensure_table(spark: SparkSession, schema: T.StructType, db: str, table: str) -> str:
    """The name of a table, created without rows if there is none."""
    name = table_name(db, table)
    if not spark.catalog.tableExists(name):
        folder = _versions(spark, db, table)
        empty = Staged(spark, db, table, f"{folder}/v-{uuid.uuid4().hex}", schema, ())
        with lease(spark, folder, empty.path):
            _finish(spark, db, table)
            if not spark.catalog.tableExists(name):
                files.make_folder(spark, empty.path)
                empty._create(False)
    return name


def append_table(df: DataFrame, db: str, table: str) -> None:
    """Append by column name; the table is created if there is none."""
    spark = df.sparkSession
    name = ensure_table(spark, df.schema, db, table)
    columns = [c for c, _ in columns_of(spark, name)]
    if {c.lower() for c in columns} != {c.lower() for c in df.columns}:
        raise ValueError(f"{name} has the columns {columns}, the rows to append {df.columns}")
    df.select(*[f"`{c}`" for c in columns]).write.insertInto(name)
