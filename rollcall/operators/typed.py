"""Checked conversion of text columns to a table's declared types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _all_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _is_nested(name: str) -> Column:
    """Whether a string field holds an object or a list, which arrive as text.

    Only a text that looks like one is looked up in the record.
    """
    value = F.try_variant_get(F.try_parse_json("_record"), f"$.{name}", "variant")
    kind = F.when(F.col(name).rlike(r"^\s*[\[{]"), F.schema_of_variant(value))
    return F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))


def typed_records(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Records by name: every field is required and must fit its type.

    Adds ``_ok``. Rejected records keep the values that did convert.
    """
    cast, ok = [], [F.col(CORRUPT).isNull()]
    for f in schema:
        value = F.col(f.name).try_cast(f.dataType)
        cast.append(value.alias(f.name))
        ok.append(value.isNotNull())
        if isinstance(f.dataType, T.StringType):
            ok.append(~_is_nested(f.name))
    rest = [c for c in rows.columns if c not in schema.names]
    return rows.select(*cast, *rest, _all_of(ok).alias("_ok")).drop(CORRUPT)


def typed_lines(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """CSV lines by position: an empty field is ``''``, so no valid integer.

    Adds ``_ok``; a line with too few or too many fields is not ok.
    """
    cast, ok = [], [f"{CORRUPT} IS NULL"]
    for f in schema:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.StringType):
            cast.append(f"coalesce({name}, '') AS {name}")
        else:
            value = f"try_cast({name} AS {f.dataType.simpleString()})"
            cast.append(f"{value} AS {name}")
            ok.append(f"{value} IS NOT NULL")
    rest = f"* EXCEPT ({', '.join(f'`{name}`' for name in schema.names)})"
    return rows.selectExpr(*cast, rest, f"{' AND '.join(ok)} AS _ok")
