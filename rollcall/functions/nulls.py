"""Null filling and integer repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import MISSING


def fill_missing(field: T.StructField) -> Column:
    """Zero for a null number, ``'0'`` for a null of any other type.

    Fractional columns become BIGINT by cutting the fraction off; a NaN counts
    as null.
    """
    col = F.col(field.name)
    kind = field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        filled = F.coalesce(F.nanvl(col, F.lit(0.0)), F.lit(0.0)).cast("bigint")
    elif isinstance(kind, T.DecimalType) and kind.scale > 0:
        filled = F.coalesce(col, F.lit(0)).cast("bigint")
    elif isinstance(kind, T.NumericType):
        filled = F.coalesce(col, F.lit(0).cast(kind))
    else:
        filled = F.coalesce(col.cast("string"), F.lit(MISSING))
    return filled.alias(field.name)
