"""The ledger of written partitions: one row per table and partition, added once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.dates import stamp_literal
from tidegate.functions.keys import partition_json, partition_key
from tidegate.functions.names import quoted, resolve_all
from tidegate.storage import empty_frame, path_has_files

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("prtc_key", T.StringType()),
        T.StructField("data_prtc", T.StringType()),
        T.StructField("last_update_date", T.TimestampType()),
        T.StructField("table_name", T.StringType()),
    ]
)
#: Partition folder of one entry; not part of what is read.
ENTRY_COLUMN = "entry"
LEDGER_KEY = ["table_name", "prtc_key"]


def partitions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct partition values; with no partition columns, one row without columns."""
    return df.select([F.col(quoted(c)) for c in resolve_all(df.columns, columns)]).distinct()


def entries(df: DataFrame, table_name: str, columns: Sequence[str], as_of: datetime) -> DataFrame:
    """Ledger rows for the partitions of ``df``, as one plan."""
    found = partitions(df, columns)
    return found.select(
        partition_key(found, columns).alias("prtc_key"),
        partition_json(found, columns).alias("data_prtc"),
        stamp_literal(as_of).alias("last_update_date"),
        F.lit(table_name).alias("table_name"),
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, one row per key.  Two jobs that raced may have added one twice; the first counts."""
    if not path_has_files(spark, path):
        return empty_frame(spark, LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    first = F.min_by(F.struct("data_prtc", "last_update_date"), F.col("last_update_date"))
    return (
        rows.groupBy(*LEDGER_KEY)
        .agg(first.alias("_first"))
        .select("prtc_key", "_first.data_prtc", "_first.last_update_date", "table_name")
    )


def absent(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates whose ``(table_name, prtc_key)`` the ledger does not hold."""
    return candidates.join(ledger.select(*LEDGER_KEY), LEDGER_KEY, "left_anti").select(
        *LEDGER_SCHEMA.names
    )


def record(
    df: DataFrame, path: str, table_name: str, columns: Sequence[str], as_of: datetime
) -> None:
    """Add the partitions of ``df`` that the ledger lacks.  A second call adds nothing.

    The ledger is partitioned by table, so only that table's entries are read.
    """
    known = read_ledger(df.sparkSession, path).where(F.col("table_name") == table_name)
    put_entries(absent(entries(df, table_name, columns, as_of), known), path)


def put_entries(fresh: DataFrame, path: str) -> None:
    """Write entries, each to the folder that the hash of its key names.

    Two jobs that race for a key write to the same folder, and the later one replaces what is there: one entry
    is on disk, not only one is read.
    """
    (
        fresh.withColumn(ENTRY_COLUMN, F.concat(F.lit("e"), F.substring(F.sha2("prtc_key", 256), 1, 32)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name", ENTRY_COLUMN)
        .parquet(path)
    )
