"""JSON records, one per line, read as text so that we decide what fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.file_head import with_origin
from ..operators.typed import CORRUPT


def _records(reader, path: str) -> DataFrame:
    lines = with_origin(reader.option("recursiveFileLookup", "true").text(path))
    return lines.filter(F.trim("value") != "").withColumnRenamed("value", "_record")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return _records(spark.read, path)


def stream_records(spark: SparkSession, path: str, files: int) -> DataFrame:
    return _records(spark.readStream.option("maxFilesPerTrigger", files), path)


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of each record as text, beside the record itself.

    ``inline`` keeps later filters above the parsing, so a record is parsed once
    and not once per field that is tested.
    """
    columns = ", ".join(f"`{name}` STRING" for name in [*schema.names, CORRUPT])
    fields = F.from_json("_record", columns, {"columnNameOfCorruptRecord": CORRUPT})
    return records.select(F.inline(F.array(fields)), *records.columns)
