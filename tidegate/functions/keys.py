"""Partition values as text keys, as JSON, and whole rows as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.names import quoted, resolve_all


def partition_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """``k1=v1#k2=v2`` in column order.  A NULL prints as ``None``, a boolean as ``True`` or ``False``."""
    if not columns:
        return F.lit("")
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(_key_text(df, name), F.lit("None")))
        for name in resolve_all(df.columns, columns)
    ]
    return F.concat_ws("#", *parts)


def partition_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """The same values as one JSON object; a NULL value keeps its name in the text."""
    if not columns:
        return F.lit("{}")
    fields = [F.col(quoted(c)).alias(c) for c in resolve_all(df.columns, columns)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to text in one projection; NULL stays NULL."""
    return df.select([F.col(quoted(c)).cast("string").alias(c) for c in df.columns])


def _key_text(df: DataFrame, name: str) -> Column:
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.when(column, F.lit("True")).when(~column, F.lit("False"))
    return column.cast("string")
