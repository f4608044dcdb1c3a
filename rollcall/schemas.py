"""The tables of the star schema and how their definitions are read."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Table names, column names and types, in column order.
TABLES = {
    "hired_employees": (
        "id BIGINT, name STRING, datetime STRING, department_id BIGINT, job_id BIGINT"
    ),
    "departments": "id BIGINT, department STRING",
    "jobs": "id BIGINT, job STRING",
}

# Integer and float type names used in definition texts.
TYPE_NAMES = {"INT64": "BIGINT", "INTEGER": "BIGINT", "FLOAT64": "DOUBLE"}

FACT = "hired_employees"


def table_schema(table: str) -> T.StructType:
    return schema_from_text(TABLES[table])


def schema_from_text(text: str) -> T.StructType:
    """Schema of a definition text such as ``id INT64,\\nname STRING``."""
    names = "|".join(TYPE_NAMES)
    ddl = re.sub(
        rf"\b({names})\b(?=\s*(,|$))",
        lambda m: TYPE_NAMES[m.group(1).upper()],
        " ".join(text.split()),
        flags=re.IGNORECASE,
    )
    return T.StructType.fromDDL(ddl)


def read_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema from a definition text file on any file system Spark can read."""
    return schema_from_text(spark.read.text(path, wholetext=True).first()[0])


def history_schema(schema: T.StructType) -> T.StructType:
    """Integer columns of a history file may carry fractions (``3.0``).

    DECIMAL(38, 18) holds every BIGINT exactly, which DOUBLE would not.
    """
    return T.StructType(
        [
            T.StructField(f.name, T.DecimalType(38, 18))
            if isinstance(f.dataType, T.LongType)
            else f
            for f in schema
        ]
    )
