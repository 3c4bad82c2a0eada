"""Sinks: partitioned parquet, headerless CSV, keyed text tables, quality outcomes, the catalog."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.dates import stamp_literal
from tidegate.functions.keys import as_text
from tidegate.functions.names import quoted, quoted_table, resolve, resolve_all
from tidegate.sources.schema import partition_columns

# Fixed values of the written tables.
STAMP_COLUMN = "last_update_date"
MAX_RECORDS_PER_FILE = 5_000_000
CODEC = "zstd"
OUTCOME_PARTITIONS = ["table_name", "anomesdia", "job"]

BATCH_COLUMN = "key_batch"
#: Partitions that one statement adds.
PARTITIONS_A_CALL = 500
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
#: Files that a task of an unsorted write keeps open; rows of partitions beyond them are sorted.
OPEN_FILES = 16


def stamped(df: DataFrame, as_of: datetime) -> DataFrame:
    """``df`` with one time of writing for all rows, in place of a column of that name if it has one."""
    present = resolve(df.columns, STAMP_COLUMN)
    if present not in (None, STAMP_COLUMN):
        df = df.withColumnRenamed(present, STAMP_COLUMN)
    return df.withColumn(STAMP_COLUMN, stamp_literal(as_of))


def balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of one output partition brought together, so that each gets few files.

    The rebalance hint leaves the sizes to adaptive execution: small partitions share a task, and one
    that holds most of the rows is split over many.  Without adaptive execution the hint would be a
    plain hash by partition value, which is one task for a hot partition, so it is left out then.
    """
    if not partition_cols or df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *[F.col(quoted(c)) for c in partition_cols])


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes in here pass rows on to the files of their partitions as they come.

    Without it Spark sorts all rows of a task by partition first, so a task that writes a large file holds that file's
    rows in memory, or spills them.  With it a task holds one row group of each of ``OPEN_FILES`` files at most.  The setting is
    the session's, and what it was before is put back.
    """
    before = spark.conf.get(OPEN_FILES_SETTING, "0")
    spark.conf.set(OPEN_FILES_SETTING, str(max(OPEN_FILES, int(before))))
    try:
        yield
    finally:
        if before == "0":
            spark.conf.unset(OPEN_FILES_SETTING)
        else:
            spark.conf.set(OPEN_FILES_SETTING, before)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    as_of: datetime | None = None,
    overwrite: str = "dynamic",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    balance: bool = True,
) -> None:
    """Write parquet by partition, stamped with ``as_of`` if given.

    ``overwrite="dynamic"`` replaces only the partitions present in ``df``, so a rerun is safe and the
    rest stays; ``"static"`` replaces the whole folder.  Without partition columns both replace all.
    ``balance=False`` saves the shuffle for rows that already lie as they should be written.
    """
    if overwrite not in ("dynamic", "static"):
        raise ValueError(f"overwrite must be 'dynamic' or 'static', not {overwrite!r}")
    columns = resolve_all(df.columns, partition_cols)
    if as_of is not None:
        df = stamped(df, as_of)
    if balance:
        df = balanced(df, columns)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", CODEC)
        .option("parquet.enable.dictionary", "true")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Headerless CSV, columns by position.  The path is a folder with one file per task."""
    df.write.mode("overwrite").option("header", "false").csv(path)


def write_outcomes(outcome_rows: DataFrame, root: str, phase: str, as_of: datetime) -> None:
    """Stamped outcomes under ``root/phase``; earlier outcomes of other tables, days and jobs stay.

    There is one row per rule, so they go into one file, by one task.
    """
    rows = outcome_rows.coalesce(1)
    write_partitioned(rows, f"{root}/{phase}", OUTCOME_PARTITIONS, as_of, balance=False)


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key.

    ``max_by`` keeps one row per key and task before the shuffle, so a hot key is no hot task.
    """
    keys = resolve_all(df.columns, keys)
    order = F.struct(*[F.col(quoted(c)) for c in resolve_all(df.columns, order_by)])
    row = F.struct(*[F.col(quoted(c)) for c in df.columns])
    return (
        df.groupBy(*[F.col(quoted(k)) for k in keys])
        .agg(F.max_by(row, order).alias("_row"))
        .select("_row.*")
    )


def keyed_text(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key, every attribute as text."""
    return as_text(latest_by_key(df, keys, order_by))


def put_keyed(
    df: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str], as_of: datetime
) -> None:
    """Put a batch into a text table by key: what ``as_of`` stamps is one batch, and only its rows are written.

    Of a key that the batch holds more than once, the last row by ``order_by`` is kept.  Batches lie side by
    side, each in a folder of its own, and ``read_keyed`` folds them.  So the cost of a batch does not depend on the
    table, batches may come late or at the same time, and one that is put again takes its own place.
    """
    rows = keyed_text(df, keys, order_by).withColumn(BATCH_COLUMN, F.lit(_batch_name(as_of)))
    write_partitioned(rows, path, [BATCH_COLUMN], balance=False)


def read_keyed(
    spark: SparkSession, path: str, keys: Sequence[str], as_of: datetime | None = None
) -> DataFrame:
    """The table as the batches up to ``as_of`` leave it: of each key the whole row of its latest batch.

    A batch holds a key once, so the stamp alone decides.  Attributes that only some batches have are NULL in
    rows of the others; every attribute is text.
    """
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    if as_of is not None:
        rows = rows.where(F.col(BATCH_COLUMN) <= _batch_name(as_of))
    return latest_by_key(rows, keys, [BATCH_COLUMN]).drop(BATCH_COLUMN)


def fold_keyed(spark: SparkSession, path: str, into: str, keys: Sequence[str], as_of: datetime) -> None:
    """The batches up to ``as_of`` as one batch of a table at another path, which later batches can be put into."""
    rows = read_keyed(spark, path, keys, as_of).withColumn(BATCH_COLUMN, F.lit(_batch_name(as_of)))
    write_partitioned(rows, into, [BATCH_COLUMN], balance=False)


def _batch_name(as_of: datetime) -> str:
    """Sorts like the time, and is no number or time that a reader would take for a value of another type."""
    return as_of.strftime("at-%Y%m%d%H%M%S%f")


def register_partitions(spark: SparkSession, identifier: str, partitioned: bool | None = None) -> None:
    """Make all partition folders of a table known to the catalog, from a listing of the whole table.

    For folders that something else wrote; ``add_partitions`` is for those of a write.  The catalog is asked
    for the table's layout if the caller does not know it.
    """
    if partitioned is None:
        partitioned = bool(partition_columns(spark, identifier))
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {quoted_table(identifier)}")
    else:
        spark.catalog.refreshTable(quoted_table(identifier))


def add_partitions(
    spark: SparkSession, identifier: str, written: DataFrame, partition_cols: Sequence[str]
) -> int:
    """Make the partitions of ``written`` rows known to the catalog, and return how many there are.

    Folders have to be named as the catalog spells the columns.  Nothing is listed.  Their distinct values come to the driver a task's share at a time, and go to the catalog
    ``PARTITIONS_A_CALL`` at a time.  Without partition columns the table is only read anew.
    """
    name = quoted_table(identifier)
    if not partition_cols:
        spark.catalog.refreshTable(name)
        return 0
    columns = resolve_all(written.columns, partition_cols)
    values = written.select([F.col(quoted(c)).cast("string").alias(c) for c in columns]).distinct()
    found = values.toLocalIterator()
    total = 0
    while some := list(itertools.islice(found, PARTITIONS_A_CALL)):
        total += len(some)
        specs = " ".join(f"PARTITION ({_partition_spec(partition_cols, row)})" for row in some)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(name)
    return total


def _partition_spec(columns: Sequence[str], row) -> str:
    """An empty text is written to the folder of NULL, so it is registered as that."""
    return ", ".join(f"{quoted(c)} = {'NULL' if v in (None, '') else _literal(v)}" for c, v in zip(columns, row))


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
