from datetime import datetime

from pyspark.sql import functions as F

from tidegate.operators.ledger import LEDGER_SCHEMA, absent, entries, partitions, put_entries, read_ledger, record
from tidegate.storage import fresh_path

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def seen(spark, path):
    rows = read_ledger(spark, path).select(
        "table_name", "prtc_key", "data_prtc", F.date_format("last_update_date", "yyyyMMdd")
    )
    return sorted(map(tuple, rows.collect()))


def test_partitions_are_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "P string, q int")
    assert partitions(df, ["p", "q"]).count() == 3
    assert partitions(df, []).count() == 1


def test_each_partition_is_recorded_once(spark):
    path = fresh_path(spark, "ledger")
    assert read_ledger(spark, path).count() == 0
    record(spark.createDataFrame([("a",), ("a",)], "p string"), path, "t", ["p"], DAY1)
    record(spark.createDataFrame([("a",), ("b",), (None,)], "p string"), path, "t", ["p"], DAY2)
    want = [
        ("t", "p=None", '{"p":null}', "20240102"),
        ("t", "p=a", '{"p":"a"}', "20240101"),
        ("t", "p=b", '{"p":"b"}', "20240102"),
    ]
    assert seen(spark, path) == want
    record(spark.createDataFrame([("a",), ("b",)], "p string"), path, "t", ["p"], datetime(2024, 1, 3))
    assert seen(spark, path) == want
    assert spark.read.parquet(path).count() == 3


def test_tables_do_not_share_entries(spark):
    path = fresh_path(spark, "ledger")
    df = spark.createDataFrame([("a",)], "p string")
    record(df, path, "t", ["p"], DAY1)
    record(df, path, "u", ["p"], DAY1)
    assert [r[:2] for r in seen(spark, path)] == [("t", "p=a"), ("u", "p=a")]


def test_a_table_without_partitions_has_one_entry(spark):
    path = fresh_path(spark, "ledger")
    for _ in range(2):
        record(spark.range(3), path, "t", [], DAY1)
    assert seen(spark, path) == [("t", "", "{}", "20240101")]


def test_entries_that_were_added_twice_count_once(spark):
    path = fresh_path(spark, "ledger")
    df = spark.createDataFrame([("a",)], "p string")
    for day in (DAY2, DAY1):
        entries(df, "t", ["p"], day).write.mode("append").partitionBy("table_name").parquet(path)
    assert seen(spark, path) == [("t", "p=a", '{"p":"a"}', "20240101")]
    assert read_ledger(spark, path).schema.names == LEDGER_SCHEMA.names


def test_two_jobs_that_race_leave_one_entry_on_disk(spark):
    path = fresh_path(spark, "ledger")
    record(spark.createDataFrame([("z",)], "p string"), path, "t", ["p"], DAY1)
    df = spark.createDataFrame([("a",), ("a#b",), (None,)], "p string")
    # Both look before either writes.
    looked = [absent(entries(df, "t", ["p"], day), read_ledger(spark, path)).collect() for day in (DAY1, DAY2)]
    assert [len(found) for found in looked] == [3, 3]
    for found in looked:
        put_entries(spark.createDataFrame(found, LEDGER_SCHEMA), path)
    assert spark.read.parquet(path).count() == 4
    assert [r[1] for r in seen(spark, path)] == ["p=None", "p=a", "p=a#b", "p=z"]
    put_entries(spark.createDataFrame(looked[0], LEDGER_SCHEMA).withColumn("table_name", F.lit("u")), path)
    assert spark.read.parquet(path).count() == 7
