"""History rows: nulls to sentinels, fractions to integers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.nulls import fill_missing


def normalise_history(df: DataFrame) -> DataFrame:
    return df.select(*[fill_missing(field) for field in df.schema])
