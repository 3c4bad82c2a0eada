from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.plans import plan_of
from tidegate.operators import maintenance
from tidegate.operators.ledger import read_ledger, record
from tidegate.operators.maintenance import (
    catalog_partitions,
    compact,
    compaction_plan,
    drop_partitions,
    expired_partitions,
    orphan_partitions,
    stored_files,
    stored_partitions,
)
from tidegate.operators.sinks import add_partitions
from tidegate.plans.queries import register, unique
from tidegate.sources import TableColumn
from tidegate.storage import fresh_path, stage


@pytest.fixture
def scattered(spark):
    """Many small files in odd partitions, one tidy partition."""
    path = fresh_path(spark, "scattered")
    p = (
        F.when(F.col("id") % 10 < 6, F.lit("01"))
        .when(F.col("id") % 10 < 8, F.lit("a:b c+d%"))
        .otherwise(F.lit(None))
    )
    df = spark.range(0, 4000, 1, 12).select("id", F.lit("x").alias("q"), p.alias("p q"))
    df.write.partitionBy("q", "p q").parquet(path)
    tidy = spark.range(4000, 4100, 1, 1).select("id", F.lit("x").alias("q"), F.lit("tidy").alias("p q"))
    tidy.write.mode("append").partitionBy("q", "p q").parquet(path)
    return path


COLUMNS = ["q", "p q"]


def files(spark, path):
    rows = stored_files(spark, path, COLUMNS).groupBy("p q").agg(F.count("*").alias("n")).collect()
    return {r["p q"]: r["n"] for r in rows}


def test_listing(spark, scattered):
    assert files(spark, scattered) == {"01": 12, "a:b c+d%": 12, None: 12, "tidy": 1}
    assert stored_partitions(spark, scattered, COLUMNS).count() == 4
    plan = plan_of(stored_files(spark, scattered, COLUMNS))
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_compaction(spark, scattered):
    before = spark.read.parquet(scattered).select("id", "p q")
    want = sorted(map(tuple, before.collect()), key=str)
    tidy = [r["path"] for r in stored_files(spark, scattered, COLUMNS).where("`p q` = 'tidy'").collect()]
    picked = compaction_plan(spark, scattered, COLUMNS).where("rewrite")
    assert {r["p q"] for r in picked.collect()} == {"01", "a:b c+d%", None}

    assert compact(spark, scattered, COLUMNS) == 3
    assert files(spark, scattered) == {"01": 1, "a:b c+d%": 1, None: 1, "tidy": 1}
    spark.catalog.refreshByPath(scattered)
    after = spark.read.parquet(scattered).select("id", "p q")
    assert sorted(map(tuple, after.collect()), key=str) == want
    left = [r["path"] for r in stored_files(spark, scattered, COLUMNS).where("`p q` = 'tidy'").collect()]
    assert left == tidy
    # Nothing is left to do.
    assert compact(spark, scattered, COLUMNS) == 0


def test_a_large_partition_is_rewritten_as_several_files(spark, scattered):
    size = stored_files(spark, scattered, COLUMNS).where("`p q` = '01'").agg(F.sum("length")).first()[0]
    compact(spark, scattered, COLUMNS, target_bytes=size // 3)
    assert 1 < files(spark, scattered)["01"] <= 4
    assert spark.read.parquet(scattered).count() == 4100


def test_picked_partitions_are_taken_in_batches(spark, scattered):
    assert compact(spark, scattered, COLUMNS, batch=1) == 3
    assert files(spark, scattered) == {"01": 1, "a:b c+d%": 1, None: 1, "tidy": 1}
    spark.catalog.refreshByPath(scattered)
    assert spark.read.parquet(scattered).count() == 4100


def test_columns_of_some_files_only_are_kept(spark):
    path = fresh_path(spark, "evolved")
    spark.range(0, 4, 1, 2).selectExpr("id", "'p' AS p").write.partitionBy("p").parquet(path)
    newer = spark.range(4, 8, 1, 2).selectExpr("id", "id * 10 AS extra", "'p' AS p")
    newer.write.mode("append").partitionBy("p").parquet(path)
    assert compact(spark, path, ["p"]) == 1
    spark.catalog.refreshByPath(path)
    got = sorted((r["id"], r["extra"]) for r in spark.read.parquet(path).collect())
    assert got == [(i, None) for i in range(4)] + [(i, i * 10) for i in range(4, 8)]


def test_a_given_schema_is_used(spark):
    path = fresh_path(spark, "given")
    df = spark.range(0, 4, 1, 2).selectExpr("id", "'01' AS p")
    df.write.partitionBy("p").parquet(path)
    assert compact(spark, path, ["p"], schema=df.schema) == 1
    assert spark.read.schema(df.schema).parquet(path).where("p = '01'").count() == 4


def test_only_picked_partitions_are_read(spark, scattered, monkeypatch):
    plans = []

    def look(df, label):
        plans.append((label, plan_of(df)))
        return stage(df, label)

    monkeypatch.setattr(maintenance, "stage", look)
    compact(spark, scattered, COLUMNS)
    assert [label for label, _ in plans] == ["compaction-plan", "compaction"]
    assert "PartitionFilters: [invoke(StructsToJson" in plans[1][1]


def test_a_table_without_partitions(spark):
    path = fresh_path(spark, "flat")
    spark.range(0, 100, 1, 10).write.parquet(path)
    assert compact(spark, path, []) == 1
    assert stored_files(spark, path, []).count() == 1
    assert spark.read.parquet(path).count() == 100


def expired(spark, days, cutoff, keep):
    df = spark.createDataFrame(days, "table_name string, day int")
    return sorted(map(tuple, expired_partitions(df, F.lit(cutoff), "day", keep).collect()))


def test_expiry_keeps_the_newest(spark):
    days = [("a", d) for d in range(1, 21)] + [("b", d) for d in (1, 2, 3)] + [("a", 5), ("a", 5)]
    assert expired(spark, days, 100, 10) == [("a", d) for d in range(1, 11)]
    assert expired(spark, days, 4, 10) == [("a", 1), ("a", 2), ("a", 3)]
    assert expired(spark, days, 3, 1) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert expired(spark, days, 1, 1) == []


def test_expiry_limits_each_table_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "table_name string, day int")
    assert "row_number(), 10, Partial" in plan_of(expired_partitions(df, F.lit(5), "day"))


def test_orphans_of_a_table_with_a_table_name_column(spark):
    ledger = fresh_path(spark, "ledger")
    df = spark.createDataFrame([("a", "1"), ("b", "1")], "table_name string, day string")
    record(df.where("table_name = 'a'"), ledger, "outcomes", df.columns, datetime(2024, 1, 1))
    found = orphan_partitions(df, "outcomes", df.columns, read_ledger(spark, ledger))
    assert [tuple(r) for r in found.collect()] == [("b", "1", "table_name=b#day=1")]


def test_orphans_and_drop(spark):
    path, ledger = fresh_path(spark, "orphans"), fresh_path(spark, "ledger")
    df = spark.createDataFrame([(1, "01", "it's"), (2, "02", "b"), (3, None, "c")], "id int, m string, n string")
    df.write.partitionBy("m", "n").parquet(path)
    record(df.where("m = '02'"), ledger, "t", ["m", "n"], datetime(2024, 1, 1))
    record(df, ledger, "other", ["m", "n"], datetime(2024, 1, 1))
    found = orphan_partitions(
        stored_partitions(spark, path, ["m", "n"]), "t", ["m", "n"], read_ledger(spark, ledger)
    )
    assert sorted(r["prtc_key"] for r in found.collect()) == ["m=01#n=it's", "m=None#n=c"]

    columns = [TableColumn("id", "int"), TableColumn("m", "string", True), TableColumn("n", "string", True)]
    table = register(spark, "tidegate_test", unique("t"), path, columns)
    spark.sql(f"MSCK REPAIR TABLE {table}")
    assert spark.table(table).count() == 3
    assert drop_partitions(spark, table, found, ["m", "n"], batch=1) == 2
    assert [r["id"] for r in spark.table(table).collect()] == [2]
    assert spark.read.parquet(path).count() == 3


def test_the_catalogs_list_of_partitions(spark):
    path = fresh_path(spark, "catalog")
    values = ["01", "a:b c+d%", "it's/x=y", "é%2B", "two\nlines", None]
    columns = [TableColumn("id", "bigint"), TableColumn("p q", "string", True), TableColumn("n", "int", True)]
    spark.createDataFrame([(i, v, i) for i, v in enumerate(values)], "id long, `p q` string, n int").write.partitionBy(
        "p q", "n"
    ).parquet(path)
    table = register(spark, "tidegate_test", unique("listed"), path, [TableColumn("id", "bigint"), TableColumn("p", "string", True), columns[2]])
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "p string, n int")
    assert add_partitions(spark, table, rows, ["p", "n"]) == 6
    found = catalog_partitions(spark, table)
    assert {(r["p"], r["n"]) for r in found.collect()} == {(v, str(i)) for i, v in enumerate(values)}
    assert "Scan" not in plan_of(found).replace("LocalTableScan", "")
    with pytest.raises(ValueError):
        catalog_partitions(spark, register(spark, "tidegate_test", unique("flat"), path, columns[:1]))


def test_several_cutoffs_are_one_pass(spark):
    days = spark.createDataFrame([("a", d) for d in range(1, 21)] + [("b", 1)], "table_name string, day int")
    found = expired_partitions(days, [4, 100], "day", 10)
    got = sorted((r["cutoff"], r["table_name"], r["day"]) for r in found.collect())
    assert got == [(4, "a", d) for d in (1, 2, 3)] + [(100, "a", d) for d in range(1, 11)]
    one = plan_of(expired_partitions(days, F.lit(4), "day", 10))
    assert plan_of(expired_partitions(days, [4, 100], "day", 10)).count("Exchange") == one.count("Exchange")
