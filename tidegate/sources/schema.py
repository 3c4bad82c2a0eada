"""Schemas come from the catalog, never from the data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidegate.functions.names import quoted_table
from tidegate.spec import SpecError

# The closed map from catalog type names to Spark types, with Spark's other plain types.
SIMPLE_TYPES = {
    "string": T.StringType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "binary": T.BinaryType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

_DECIMAL = re.compile(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)")
_NESTED = re.compile(r"(array|map|struct)<.*", re.DOTALL)


@dataclass(frozen=True)
class TableColumn:
    name: str
    type_text: str
    is_partition: bool = False


def map_type(type_text: str, keep_nested: bool = False) -> T.DataType:
    """The Spark type of a catalog type name; a name outside the map is text.

    ``keep_nested`` keeps arrays, maps and structs as they are declared.
    """
    text = type_text.strip().lower()
    if decimal := _DECIMAL.fullmatch(text):
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    if keep_nested and _NESTED.fullmatch(text):
        return T.DataType.fromDDL(type_text)
    return SIMPLE_TYPES.get(text.partition("(")[0], T.StringType())


def table_columns(spark: SparkSession, identifier: str) -> list[TableColumn]:
    """Columns of a catalog table, partition columns last."""
    return [
        TableColumn(c.name, c.dataType, c.isPartition)
        for c in spark.catalog.listColumns(quoted_table(identifier))
    ]


def check_writable(columns: Sequence[TableColumn], keep_nested: bool = False) -> None:
    """Refuse a table with a column whose mapped type is not the column's own: its files could not be read."""
    for column in columns:
        text = column.type_text.strip().lower()
        own = T.StringType() if text.startswith(("char", "varchar")) else T.DataType.fromDDL(column.type_text)
        if map_type(column.type_text, keep_nested) != own:
            raise SpecError(f"column {column.name} of type {column.type_text} would be written as another type")


def table_location(spark: SparkSession, identifier: str) -> str | None:
    """Where the catalog says a table lies."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(identifier)}").where("col_name = 'Location'")
    found = rows.first()
    return found["data_type"] if found else None


def partition_columns(spark: SparkSession, identifier: str) -> list[str]:
    return [c.name for c in table_columns(spark, identifier) if c.is_partition]


def scan_schema(columns: Sequence[TableColumn], keep_nested: bool = False) -> T.StructType:
    """The schema a headerless file is read with: position counts, every field may be NULL."""
    return T.StructType(
        [T.StructField(c.name, map_type(c.type_text, keep_nested), True) for c in columns]
    )
