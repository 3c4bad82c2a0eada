"""Upkeep of partitioned parquet tables: compaction, expiry, orphans.

Plans come from file listings and distinct partition values, so they grow with the number of files,
not with the number of rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.keys import partition_json, partition_key
from tidegate.functions.names import quoted, quoted_table
from tidegate.operators.sinks import CODEC, unsorted_writes
from tidegate.sources.schema import partition_columns
from tidegate.storage import stage

# Fixed values of the maintenance calls.
TARGET_FILE_BYTES = 256 * 1024 * 1024
KEEP_NEWEST = 10
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def stored_files(spark: SparkSession, root: str, partition_cols: Sequence[str]) -> DataFrame:
    """One row per parquet file: partition values as text, ``path`` and ``length``.  No file is opened."""
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("modificationTime", T.TimestampType()),
            T.StructField("length", T.LongType()),
            T.StructField("content", T.BinaryType()),
            *[T.StructField(c, T.StringType()) for c in partition_cols],
        ]
    )
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .schema(schema)
        .load(root)
        .select(*_columns(partition_cols), "path", "length")
    )


def stored_partitions(spark: SparkSession, root: str, partition_cols: Sequence[str]) -> DataFrame:
    """Partition values that have files, as text, from the listing alone."""
    return stored_files(spark, root, partition_cols).select(*_columns(partition_cols)).distinct()


def catalog_partitions(spark: SparkSession, identifier: str) -> DataFrame:
    """Partition values that the catalog knows, as text, NULL for the folder of NULL.

    The list is the catalog's own: no folder is listed and no file is looked at, so its cost follows the number of
    partitions, not that of files or rows.
    """
    columns = partition_columns(spark, identifier)
    if not columns:
        raise ValueError(f"{identifier} has no partitions")
    specs = spark.sql(f"SHOW PARTITIONS {quoted_table(identifier)}").withColumn("parts", F.split("partition", "/"))
    return specs.select([_folder_value(i).alias(c) for i, c in enumerate(columns)])


def _folder_value(i: int) -> Column:
    """The value in the ``i``-th folder name: after the ``=``, with ``%XX`` read back.

    A plus is no blank in folder names, so it is kept from the URL rules.
    """
    raw = F.regexp_extract(F.col("parts")[i], "(?s)^[^=]*=(.*)$", 1)
    text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != NULL_FOLDER, text)


def compaction_plan(
    spark: SparkSession,
    root: str,
    partition_cols: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Per partition: files, bytes, files planned, and whether a rewrite is worth its cost.

    A partition is rewritten if it has at least two files below half the target and more files than
    planned.  After a rewrite it has at most the planned number, so the plan comes to rest.
    """
    planned = F.greatest(F.ceil(F.col("n_bytes") / target_bytes), F.lit(1)).cast("int")
    return (
        stored_files(spark, root, partition_cols)
        .groupBy(*_columns(partition_cols))
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.count_if(F.col("length") < target_bytes // 2).alias("n_small"),
            F.sum("length").alias("n_bytes"),
        )
        .withColumn("planned_files", planned)
        .withColumn("rewrite", (F.col("n_small") >= 2) & (F.col("n_files") > F.col("planned_files")))
    )


def compact(
    spark: SparkSession,
    root: str,
    partition_cols: Sequence[str],
    target_bytes: int = TARGET_FILE_BYTES,
    batch: int = 2000,
    schema: T.StructType | None = None,
) -> int:
    """Rewrite the partitions the plan picks and return how many files they have now, at most.

    ``schema`` is the table's, partition columns left out or not.  Without it the schemas of all files
    are merged, so that no column of an older or newer file gets lost.

    Picked partitions are taken ``batch`` at a time, so the list that prunes the scan to them stays
    small, however many there are.
    """
    picked = compaction_plan(spark, root, partition_cols, target_bytes).where("rewrite")
    picked = picked.select(
        *_columns(partition_cols),
        F.col("planned_files").alias("_planned"),
        partition_json(picked, partition_cols).alias("_key"),
    )
    if schema is None:
        schema = spark.read.option("mergeSchema", "true").parquet(root).schema
    files = 0
    # Staged, because every rewrite changes the listing the plan is made from.
    held = stage(picked, "compaction-plan")
    try:
        listed = held.frame.toLocalIterator()
        while some := list(itertools.islice(listed, batch)):
            keys = [r["_key"] for r in some]
            plan = held.frame.where(F.col("_key").isin(keys)).drop("_key")
            rows = _text_partitions(spark, root, partition_cols, schema)
            files += _rewrite(rows, root, partition_cols, keys, plan, sum(r["_planned"] for r in some))
    finally:
        held.release()
    return files


def _rewrite(
    rows: DataFrame, root: str, partition_cols, keys: list[str], plan: DataFrame, files: int
) -> int:
    """One batch: copied to a staged table, because a folder must not be replaced while it is read,
    then written back, partition by partition, while the copy is still there.

    The way back shuffles by partition and a salt below the number of planned files, so a partition
    that holds most of the data is split over many tasks, and none gets more files than planned.  A task gets
    the rows of a whole file, so they are written as they come, not sorted.
    """
    rows = rows.where(partition_json(rows, partition_cols).isin(keys))
    plan = plan.toDF(*[f"_p{i}" for i in range(len(partition_cols))], "_planned")
    same = F.lit(True)
    for i, column in enumerate(partition_cols):
        same = same & rows[quoted(column)].eqNullSafe(F.col(f"_p{i}"))
    chosen = rows.join(F.broadcast(plan), same, "inner").select(
        *[F.col(quoted(c)) for c in rows.columns], "_planned"
    )
    held = stage(chosen, "compaction")
    # Input splits are whole files or slices of them, the same again when a task is repeated.
    salted = held.frame.withColumn("_bin", F.pmod(F.spark_partition_id(), F.col("_planned")))
    dealt = salted.repartition(files, *_columns(partition_cols), F.col("_bin")).drop("_bin", "_planned")
    with unsorted_writes(rows.sparkSession):
        (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(*partition_cols)
            .parquet(root)
        )
    held.release()
    return files


def expired_partitions(
    partitions: DataFrame,
    cutoff: Column | str | Sequence,
    date_column: str,
    keep: int = KEEP_NEWEST,
) -> DataFrame:
    """Partitions strictly older than the cutoff, never one of a table's ``keep`` newest dates.

    ``partitions`` has ``table_name`` and the date.  Each task hands on only the newest ``keep`` dates
    per table, so a table with very many partitions does not end up in one task.  Several cutoffs (a list of values)
    are looked at in one pass; a column ``cutoff`` then tells them apart.
    """
    listed = partitions.select("table_name", date_column).distinct()
    newest = Window.partitionBy("table_name").orderBy(F.desc(date_column))
    floor = (
        listed.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= keep)
        .groupBy("table_name")
        .agg(F.min(date_column).alias("_floor"))
    )
    old = listed.join(floor, "table_name").where(F.col(date_column) < F.col("_floor")).drop("_floor")
    if isinstance(cutoff, (list, tuple)):
        old = old.withColumn("cutoff", F.explode(F.array(*[F.lit(c) for c in cutoff])))
        return old.where(F.col(date_column) < F.col("cutoff"))
    return old.where(F.col(date_column) < cutoff)


def orphan_partitions(
    partitions: DataFrame, table_name: str, columns: Sequence[str], ledger: DataFrame
) -> DataFrame:
    """Partitions of a table that the ledger does not know.  A report; nothing is removed."""
    listed = partitions.select(*_columns(columns)).distinct()
    keyed = listed.withColumn("prtc_key", partition_key(listed, columns))
    known = ledger.where(F.col("table_name") == table_name).select("prtc_key")
    return keyed.join(known, "prtc_key", "left_anti").select(*_columns(columns), "prtc_key")


def drop_partitions(
    spark: SparkSession, table: str, partitions: DataFrame, columns: Sequence[str], batch: int = 500
) -> int:
    """Take partitions out of the catalog, on request only.

    The list is staged, because it may come from what is dropped, and reaches the driver in batches.
    """
    values = partitions.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns])
    held = stage(values, "drop-list")
    dropped = 0
    try:
        rows = held.frame.toLocalIterator()
        while some := list(itertools.islice(rows, batch)):
            specs = [", ".join(_equals(c, row[c]) for c in columns) for row in some]
            listed = ", ".join(f"PARTITION ({spec})" for spec in specs)
            spark.sql(f"ALTER TABLE {quoted_table(table)} DROP IF EXISTS {listed}")
            dropped += len(some)
    finally:
        held.release()
    return dropped


def _equals(column: str, value: str | None) -> str:
    if value is None:
        return f"{quoted(column)} = NULL"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"{quoted(column)} = '{escaped}'"


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def _text_partitions(
    spark: SparkSession, root: str, partition_cols: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The table with its partition values as the folder names have them, leading zeros included."""
    fields = [f for f in schema.fields if f.name not in partition_cols]
    fields += [T.StructField(c, T.StringType()) for c in partition_cols]
    return spark.read.schema(T.StructType(fields)).parquet(root)
