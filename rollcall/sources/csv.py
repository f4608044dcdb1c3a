"""CSV in and out, with one quoting rule: ``"`` quotes, doubled inside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.file_head import with_origin
from ..operators.typed import CORRUPT

FORMAT = {"sep": ",", "quote": '"', "escape": '"'}
# Every .csv file at any depth below the given path.
FILES = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}


# What the error of such a line says.
OPEN_QUOTE = "a quote does not close"


# Whether a quote of a line does not close: files are split by line.
OPEN_QUOTES = """(length(value) - length(replace(value, '"', ''))) % 2 = 1"""


def text_for_null(rows: DataFrame) -> DataFrame:
    """Text columns with an empty text where the reader gave null.

    The reader cannot tell them apart; a landed line gives the same.
    """
    return rows.select(
        *[
            F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) if kind == "string" else F.col(f"`{name}`")
            for name, kind in rows.dtypes
        ]
    )


def read_declared(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = False
) -> DataFrame:
    """Rows under a declared schema; a line that does not fit fails the query.

    So does a line with a quote that it does not close, which a scan would take
    as a row and go on with the next line. Lines are parsed one by one while they
    are read: the files are read once, and not before the rows are asked for.
    """
    lines = _headed_lines(spark, path) if header else read_lines(spark, path)
    said = F.concat(F.lit(f"{OPEN_QUOTE} in "), "_file", F.lit(": "), F.substring("value", 1, 200))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    fields = F.from_csv("value", ddl, {**FORMAT, "mode": "FAILFAST"})
    checked = F.when(F.expr(OPEN_QUOTES), F.raise_error(said).cast(schema)).otherwise(fields)
    return lines.select(F.inline(F.array(checked)))


# No field separator: what the scan gives for a line is the line.
_WHOLE_LINE = {"sep": "\x01\x02\x01", "quote": "", "escape": "", "mode": "FAILFAST"}


def _headed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their origin, without the first line of each file."""
    reader = spark.read.schema("value STRING").options(**_WHOLE_LINE, **FILES, header=True)
    return with_origin(reader.csv(path)).filter(F.trim("value") != "")


def _lines(reader, path: str) -> DataFrame:
    lines = with_origin(reader.options(**FILES).text(path))
    return lines.filter(F.trim("value") != "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they are, with their origin; parse the ones that are wanted."""
    return _lines(spark.read, path)


def stream_lines(spark: SparkSession, path: str, files: int) -> DataFrame:
    return _lines(spark.readStream.option("maxFilesPerTrigger", files), path)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of each line as text, and the line itself if it does not fit."""
    columns = ", ".join(f"`{name}` STRING" for name in [*schema.names, CORRUPT])
    options = ", ".join(f"'{k}', '{v}'" for k, v in {**FORMAT, "columnNameOfCorruptRecord": CORRUPT}.items())
    return lines.selectExpr(f"from_csv(value, '{columns}', map({options})) AS _fields", "*").selectExpr(
        *[f"_fields.`{name}`" for name in schema.names],
        f"CASE WHEN {OPEN_QUOTES} THEN value ELSE _fields.{CORRUPT} END AS {CORRUPT}",
        "* EXCEPT (_fields, value)",
    )


def write(df: DataFrame, path: str, header: bool = False) -> None:
    df.write.mode("overwrite").options(
        **FORMAT,
        header=header,
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def create_raw_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, header: bool = False
) -> None:
    """Create or replace a table over CSV files that stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(
        name, path, "csv", schema, header=str(header).lower(), mode="FAILFAST", **FORMAT, **FILES
    )
