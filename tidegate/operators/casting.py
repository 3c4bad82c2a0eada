"""Cast a frame to the columns its target table declares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.casts import lenient_cast
from tidegate.functions.names import quoted, resolve
from tidegate.sources.schema import TableColumn, map_type


def cast_to_columns(
    df: DataFrame, columns: Sequence[TableColumn], keep_nested: bool = False
) -> DataFrame:
    """Cast in place by name, in one projection.

    A column the table knows takes the table's spelling and type, a value that does not parse turns
    NULL.  No column is added, dropped or moved.
    """
    targets = {}
    for column in columns:
        found = resolve(df.columns, column.name)
        if found is not None:
            targets[found] = column
    return df.select(
        [_cast(field, targets.get(field.name), keep_nested) for field in df.schema.fields]
    )


def _cast(field: T.StructField, target: TableColumn | None, keep_nested: bool):
    column = F.col(quoted(field.name))
    if target is None:
        return column
    cast = lenient_cast(column, field.dataType, map_type(target.type_text, keep_nested))
    return cast.alias(target.name)
