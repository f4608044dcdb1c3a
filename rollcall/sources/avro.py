"""Avro in and out, with or without the external data source module."""

from __future__ import annotations

from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value: the file format class that ships inside Spark itself.
BUILT_IN = "org.apache.spark.sql.avro.AvroFileFormat"


@lru_cache(maxsize=None)
def avro_format(spark: SparkSession) -> str:
    """``avro`` if its module is deployed, else the class inside Spark."""
    try:
        spark.read.format("avro").schema("x INT").load([])
    except AnalysisException as error:
        if "Failed to find data source" in str(error):
            return BUILT_IN
    return "avro"


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(avro_format(spark))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write(df: DataFrame, path: str) -> None:
    """Snappy blocks; dates and timestamps are written as Avro logical types."""
    avro = avro_format(df.sparkSession)
    df.write.format(avro).option("compression", "snappy").mode("overwrite").save(path)
