from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.plans import plan_of
from tidegate.operators.maintenance import stored_files
from tidegate.operators.quality import OUTCOME_SCHEMA, STORED_OUTCOME_SCHEMA, stamp_outcomes
from tidegate.operators import sinks
from tidegate.operators.sinks import (
    add_partitions,
    balanced,
    fold_keyed,
    keyed_text,
    latest_by_key,
    put_keyed,
    read_keyed,
    stamped,
    write_outcomes,
    write_partitioned,
)
from tidegate.plans.queries import register, unique
from tidegate.sources import TableColumn
from tidegate.storage import fresh_path

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
AS_OF = datetime(2024, 2, 1, 12, 30, 15, 123456)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_one_stamp_for_all_rows(spark):
    df = stamped(spark.createDataFrame([(1, "old"), (2, "old")], "id int, LAST_UPDATE_DATE string"), AS_OF)
    assert df.dtypes == [("id", "int"), ("last_update_date", "timestamp")]
    text = F.date_format("last_update_date", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert {r[0] for r in df.select(text).collect()} == {"2024-02-01 12:30:15.123456"}


def test_only_partitions_in_the_data_are_replaced(spark):
    path = fresh_path(spark, "sink")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, p string")
    write_partitioned(df, path, ["P"])
    write_partitioned(spark.createDataFrame([(9, "a")], "id int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "id", "p") == [(2, "b"), (3, None), (9, "a")]
    # The same again changes nothing.
    write_partitioned(spark.createDataFrame([(9, "a")], "id int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "id", "p") == [(2, "b"), (3, None), (9, "a")]
    # Nothing written, nothing replaced.
    write_partitioned(df.where("false"), path, ["p"])
    assert spark.read.parquet(path).count() == 3


def test_static_overwrite_replaces_all(spark):
    path = fresh_path(spark, "sink")
    write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string"), path, ["p"])
    write_partitioned(
        spark.createDataFrame([(9, "a")], "id int, p string"), path, ["p"], overwrite="static"
    )
    assert rows(spark.read.parquet(path), "id", "p") == [(9, "a")]
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1), path, [], overwrite="append")


def test_no_partition_columns(spark):
    path = fresh_path(spark, "sink")
    write_partitioned(spark.range(5), path, [], AS_OF)
    write_partitioned(spark.range(3), path, [], AS_OF)
    assert spark.read.parquet(path).count() == 3


def test_missing_partition_column(spark):
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1), fresh_path(spark, "sink"), ["p"])


def test_few_files_per_partition_and_a_row_cap_per_file(spark):
    df = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 4).alias("p"))
    path = fresh_path(spark, "sink")
    write_partitioned(df, path, ["p"])
    counts = stored_files(spark, path, ["p"]).groupBy("p").count().collect()
    assert len(counts) == 4 and all(r["count"] <= 2 for r in counts)
    write_partitioned(df, path, ["p"], max_records_per_file=100)
    assert stored_files(spark, path, ["p"]).count() >= 40
    assert spark.read.parquet(path).count() == 4000


def test_a_hot_partition_is_not_left_to_one_task_without_adaptive_execution(spark):
    df = spark.range(10).withColumn("p", F.lit(1))
    assert "Exchange" in plan_of(balanced(df, ["p"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in plan_of(balanced(df, ["p"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_partition_is_split(spark):
    """Nine of ten rows in one partition: they are written by several tasks, as several files."""
    wide = F.concat(*[F.sha2(F.concat("id", F.lit(i)), 512) for i in range(4)])
    df = spark.range(0, 20000, 1, 8).select(
        wide.alias("v"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("p")
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = fresh_path(spark, "sink")
        write_partitioned(df, path, ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {r["p"]: r["count"] for r in stored_files(spark, path, ["p"]).groupBy("p").count().collect()}
    assert files["a"] > 3
    assert spark.read.parquet(path).count() == 20000


def test_outcomes_of_other_tables_and_days_stay(spark):
    root = fresh_path(spark, "outcomes")

    def put(table, day, rule):
        rows = spark.createDataFrame([(rule, "Passed", 1.0, None)], OUTCOME_SCHEMA)
        write_outcomes(stamp_outcomes(rows, table, day), root, "predq", day)

    put("a", datetime(2024, 1, 1), "r1")
    put("b", datetime(2024, 1, 1), "r1")
    put("a", datetime(2024, 1, 2), "r1")
    put("a", datetime(2024, 1, 2), "r2")
    stored = spark.read.schema(STORED_OUTCOME_SCHEMA).parquet(f"{root}/predq")
    assert rows(stored, "table_name", "anomesdia", "rule") == [
        ("a", "20240101", "r1"),
        ("a", "20240102", "r2"),
        ("b", "20240101", "r1"),
    ]


def test_latest_by_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 2, "m"), ("b", None, "q")],
        "k string, at int, v string",
    )
    assert rows(latest_by_key(df, ["K"], ["at"]), "k", "v") == [("a", "y"), ("b", "q"), (None, "m")]


def test_a_put_replaces_whole_rows(spark):
    path = fresh_path(spark, "keyed")
    first = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "n")], "k int, at int, v string"
    )
    second = spark.createDataFrame(
        [(2, 0, None), (3, 9, "d"), (None, 1, "o")], "k int, at int, v string"
    )
    put_keyed(first, path, ["K"], ["at"], DAY1)
    one = [("1", "2", "b"), ("2", "1", "c"), (None, "1", "n")]
    assert rows(read_keyed(spark, path, ["K"]), "k", "at", "v") == one
    want = [("1", "2", "b"), ("2", "0", None), ("3", "9", "d"), (None, "1", "o")]
    for _ in range(2):
        put_keyed(second, path, ["K"], ["at"], DAY2)
        assert rows(read_keyed(spark, path, ["k"]), "k", "at", "v") == want
    assert rows(read_keyed(spark, path, ["k"], as_of=DAY1), "k", "at", "v") == one


def test_a_late_older_batch_does_not_win(spark):
    path = fresh_path(spark, "keyed")
    put_keyed(spark.createDataFrame([(1, "new")], "k int, v string"), path, ["k"], ["v"], DAY2)
    put_keyed(spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string"), path, ["k"], ["v"], DAY1)
    assert rows(read_keyed(spark, path, ["k"]), "k", "v") == [("1", "new"), ("2", "old")]


def test_a_put_writes_only_its_own_rows(spark):
    path = fresh_path(spark, "keyed")
    table = spark.range(1000).select("id", F.lit("old").alias("v"))
    put_keyed(table, path, ["id"], ["v"], DAY1)
    before = {r["path"] for r in stored_files(spark, path, ["key_batch"]).collect()}
    put_keyed(table.where("id = 7").withColumn("v", F.lit("new")), path, ["id"], ["v"], DAY2)
    after = {r["path"] for r in stored_files(spark, path, ["key_batch"]).collect()}
    assert before < after and spark.read.parquet(*(after - before)).count() == 1
    got = read_keyed(spark, path, ["id"])
    assert got.count() == 1000 and rows(got.where("v = 'new'"), "id") == [("7",)]


def test_a_table_does_not_depend_on_the_number_of_tasks(spark):
    df = spark.range(500).select((F.col("id") % 100).alias("k"), "id", F.col("id").cast("string").alias("v"))
    found = []
    for cores in ("8", "16"):
        path = fresh_path(spark, "keyed")
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", cores)
        try:
            put_keyed(df.where("id < 300"), path, ["k"], ["id"], DAY1)
            put_keyed(df.where("id >= 300 AND k < 50"), path, ["k"], ["id"], DAY2)
            found.append(rows(read_keyed(spark, path, ["k"]), "k", "id", "v"))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == 100


def test_batches_are_folded_into_a_new_table(spark):
    path, other = fresh_path(spark, "keyed"), fresh_path(spark, "folded")
    put_keyed(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"], ["v"], DAY1)
    put_keyed(spark.createDataFrame([(2, "c"), (3, "d")], "k int, w string"), path, ["k"], ["w"], DAY2)
    want = [("1", "a", None), ("2", None, "c"), ("3", None, "d")]
    assert rows(read_keyed(spark, path, ["k"]), "k", "v", "w") == want
    fold_keyed(spark, path, other, ["k"], DAY2)
    assert rows(read_keyed(spark, other, ["k"]), "k", "v", "w") == want
    assert stored_files(spark, other, ["key_batch"]).select("key_batch").distinct().count() == 1


PARTITION_VALUES = ["01", "a:b c+d%", "it's \\ back", "é/x=y", None]


def test_written_partitions_are_added_without_a_listing(spark, monkeypatch):
    path = fresh_path(spark, "added")
    columns = [TableColumn("id", "bigint"), TableColumn("p", "string", True), TableColumn("d", "date", True)]
    table = register(spark, "tidegate_test", unique("added"), path, columns)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(PARTITION_VALUES * 3)], "id long, p string")
    df = df.withColumn("d", F.expr("date_add(DATE'2024-01-01', int(id % 3))"))
    write_partitioned(df, path, ["p", "d"])
    monkeypatch.setattr(sinks, "PARTITIONS_A_CALL", 4)
    for _ in range(2):
        assert add_partitions(spark, table, df, ["p", "d"]) == 15
        got = spark.table(table)
        assert got.count() == 15 and {r["p"] for r in got.collect()} == set(PARTITION_VALUES)
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 15
    more = df.where("p = '01'").withColumn("p", F.lit("02"))
    write_partitioned(more, path, ["p", "d"])
    assert spark.table(table).count() == 15
    assert add_partitions(spark, table, more, ["p", "d"]) == 3 and spark.table(table).count() == 18
    flat = register(spark, "tidegate_test", unique("flat"), fresh_path(spark, "flat"), columns[:1])
    assert add_partitions(spark, flat, df, []) == 0


def test_keyed_text_folds_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id")
    plan = plan_of(keyed_text(df, ["user_id"], ["ts", "event_id"]))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan
