"""Scans.  Every one is lazy: no counts, no schema inference, filters left to the optimizer."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegate.functions.names import quoted, quoted_table
from tidegate.sources.schema import scan_schema, table_columns
from tidegate.spec import FILE_DATE_TOKEN, Dependency, JobSpec, SpecError, render_predicates
from tidegate.storage import Lake


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headerless CSV.  A bad field or a short row gives NULL, extra fields are dropped."""
    return spark.read.schema(schema).option("header", "false").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_catalog(spark: SparkSession, identifier: str, predicate: str | None = None) -> DataFrame:
    """A catalog table, filtered.  Its name is ``database.table``, nothing less and nothing more.

    A predicate on partition columns prunes partitions, one on other columns reaches the file reader.
    """
    if len(identifier.split(".")) != 2:
        raise SpecError(f"{identifier!r} is not of the form database.table")
    frame = spark.table(quoted_table(identifier))
    return frame.where(predicate) if predicate else frame


def dated_name(name: str, as_of: datetime) -> str:
    """A file name with its date token replaced by the run's date; no other token is known."""
    return name.replace(FILE_DATE_TOKEN, as_of.strftime(FILE_DATE_TOKEN))


def expose_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` a named relation for SQL.  SQL finds it without regard to case."""
    df.createOrReplaceTempView(quoted(name))
    return df


def drop_view(spark: SparkSession, name: str) -> None:
    """Take back what ``expose_view`` made; a DataFrame made from SQL over it stays valid."""
    spark.catalog.dropTempView(name)


def refuse_taken(spark: SparkSession, names: Iterable[str]) -> None:
    """Views of a job must be its own: a name that the session uses already is refused."""
    taken = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    if both := sorted(taken & {n.lower() for n in names}):
        raise SpecError(f"the session has views of these names already: {both}")


def read_dependency(
    spark: SparkSession, spec: JobSpec, dependency: Dependency, lake: Lake, as_of: datetime
) -> DataFrame:
    """The scan of one dependency, by the layer of the job that asks for it."""
    return _READERS[spec.layer](spark, spec, dependency, lake, as_of)


def _landing(spark, spec, dependency, lake, as_of) -> DataFrame:
    path = lake.landing_file(spec.table, dated_name(dependency.table, as_of))
    return read_csv(spark, path, scan_schema(table_columns(spark, spec.identifier)))


def _catalog(spark, spec, dependency, lake, as_of) -> DataFrame:
    return read_catalog(
        spark, dependency.identifier, render_predicates(dependency.predicates, as_of)
    )


_READERS = {"CSV": _landing, "SOR": _catalog, "SOT": _catalog, "SPEC": _catalog}
