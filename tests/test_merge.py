from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.plans import plan_of
from tidegate.operators import merge
from tidegate.operators.merge import merge_insert, merged, new_rows, normal_forms, possible_hits, profile_keys
from tidegate.plans.queries import register, unique
from tidegate.sources import TableColumn
from tidegate.storage import fresh_path

PATHS = {
    "broadcast": {},
    "shuffle": {"broadcast_bytes": 0},
}


def make(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def want(source, target):
    known = {k for k, _ in target if k is not None}
    return Counter(r for r in source if r[0] not in known)


@pytest.mark.parametrize("how", PATHS)
def test_duplicates_and_nulls_are_inserted(spark, how):
    source = [(1, "a"), (2, "b"), (2, "b"), (2, "c"), (None, "n"), (None, "n")]
    target = [(1, "t"), (1, "t"), (None, "t")]
    got = new_rows(make(spark, source), make(spark, target), ["K"], **PATHS[how])
    assert Counter(map(tuple, got.collect())) == want(source, target)


@pytest.mark.parametrize("how", PATHS)
def test_empty_sides(spark, how):
    some = [(1, "a"), (None, "b")]
    empty = make(spark, [])
    assert new_rows(empty, make(spark, some), ["k"], **PATHS[how]).count() == 0
    assert new_rows(make(spark, some), empty, ["k"], **PATHS[how]).count() == 2


@pytest.mark.parametrize("how", PATHS)
def test_several_keys(spark, how):
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, None, 3)], "x int, y string, n int")
    target = spark.createDataFrame([(1, "a"), (1, None)], "X int, Y string")
    got = new_rows(source, target, ["x", "y"], **PATHS[how])
    assert sorted(r["n"] for r in got.collect()) == [2, 3]


KEYS = st.one_of(st.none(), st.integers(0, 5))
ROWS = st.lists(st.tuples(KEYS, st.sampled_from("ab")), max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_any_key_sets_on_every_path(spark, source, target):
    s, t = make(spark, source).repartition(3), make(spark, target)
    for options in (*PATHS.values(), {"broadcast_bytes": 0, "hot_share": 0.0, "hot_rows": 3, "key_filter": False}):
        got = new_rows(s, t, ["k"], **options)
        assert Counter(map(tuple, got.collect())) == want(source, target), options


def skewed(spark):
    """A third of the rows with one key, a third with no key, the rest with a key each."""
    case = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.lit(None))
    return spark.range(0, 30000, 1, 8).select(case.otherwise(F.col("id")).alias("k"), "id")


def test_profile_finds_hot_keys(spark):
    profile = profile_keys(skewed(spark), ["k"], hot_rows=1000)
    hashes = spark.range(1).select(F.xxhash64(F.lit(-1).cast("long")), F.xxhash64(F.lit(None).cast("long")))
    assert set(profile.hot_hashes) == set(hashes.first())
    assert profile.rows == 30000 and profile.key_bytes == 30000 * 32


@pytest.mark.parametrize("known", [[-1, 2, 5], [2, 5]])
def test_rows_of_hot_keys_are_not_shuffled(spark, known):
    source = skewed(spark)
    target = spark.createDataFrame([(k,) for k in known for _ in range(3)], "k long")
    options = {"broadcast_bytes": 0, "key_filter": False}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain = new_rows(source, target, ["k"], **options).withColumn("task", F.spark_partition_id())
        split = new_rows(source, target, ["k"], hot_rows=1000, **options).withColumn(
            "task", F.spark_partition_id()
        )
        assert plain.drop("task").exceptAll(split.drop("task")).count() == 0
        assert plain.count() == split.count() == 30000 - len(set(known)) - (9999 if -1 in known else 0)
        plan = plan_of(split)
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
        # The keyless third is one task's load in the plain plan, and stays with its readers here.
        assert fullest(plain) >= 10000 > 3000 > fullest(split)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def fullest(df):
    keyless = df.where("k IS NULL").groupBy("task").count()
    return keyless.agg(F.max("count")).first()[0]


def test_only_keys_of_the_target_are_read(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumnRenamed(
        "l_orderkey", "o_orderkey"
    )
    plan = plan_of(new_rows(orders, lines, ["o_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_merge_into_a_table_twice(spark):
    columns = [TableColumn("id", "bigint"), TableColumn("v", "string"), TableColumn("p", "int", True)]
    table = register(spark, "tidegate_test", unique("m"), fresh_path(spark, "merge-test"), columns)
    spark.createDataFrame([(1, "t", 1)], "id long, v string, p int").write.insertInto(table)
    source = spark.createDataFrame([(5, "s", 1), (6, "s", 2), (7, "r", 2)], "P int, V string, ID int")
    for _ in range(2):
        merge_insert(spark, source, table, ["id"])
        got = sorted(map(tuple, spark.table(table).collect()))
        assert got == [(1, "t", 1), (2, "r", 7), (2, "s", 6)]


def test_merged_frame_and_mismatched_columns(spark):
    target = make(spark, [(1, "t")])
    source = spark.createDataFrame([("s", 1), ("s", 2)], "V string, K int")
    assert sorted(map(tuple, merged(source, target, ["k"]).collect())) == [(1, "t"), (2, "s")]
    with pytest.raises(ValueError):
        merged(spark.createDataFrame([(1,)], "k int"), target, ["k"])
    with pytest.raises(ValueError):
        merged(spark.createDataFrame([(2, "x")], "k int, other string"), target, ["k"])


TYPES = [
    ("int", "long"), ("decimal(10,2)", "decimal(12,4)"), ("string", "int"), ("long", "string"),
    ("decimal(38,0)", "decimal(38,18)"), ("decimal(38,18)", "long"), ("double", "long"), ("short", "float"),
    ("float", "double"), ("tinyint", "decimal(38,38)"),
]
WAYS = {
    "broadcast": {},
    "shuffle": {"broadcast_bytes": 0, "key_filter": False},
    "filter": {"broadcast_bytes": 0},
    "hot": {"broadcast_bytes": 0, "hot_share": 0.0, "hot_rows": 5},
}


@pytest.mark.parametrize("how", WAYS)
@pytest.mark.parametrize("one,two", TYPES)
def test_keys_of_two_types_meet_on_every_path(spark, how, one, two):
    known, new = ("0", "-0.5") if two == "decimal(38,38)" else ("1", "2")
    source = spark.createDataFrame([(known,)] * 10 + [("2",)], "k string").select(F.col("k").cast(one))
    target = spark.createDataFrame([(known,), (None,)], "k string").select(F.col("k").cast(two))
    got = [float(r["k"]) for r in new_rows(source, target, ["k"], **WAYS[how]).collect()]
    assert got == [2.0] and new


UNLIKE = [
    ("decimal(38,0)", "2", "decimal(38,18)", "1.5"),
    ("decimal(38,0)", "-2", "decimal(38,18)", "-1.5"),
    ("decimal(38,18)", "1.000000000000000001", "decimal(38,0)", "1"),
    ("decimal(10,1)", "0.1", "decimal(10,2)", "0.11"),
    ("long", "9007199254740993", "double", "9007199254740992"),
    ("double", "1.5", "int", "1"),
    ("double", "1e300", "long", "9223372036854775807"),
    ("long", "9223372036854775807", "double", "9223372036854775807"),
    ("string", "01", "int", "1"),
    ("float", "0.1", "double", "0.1"),
]


@pytest.mark.parametrize("how", WAYS)
@pytest.mark.parametrize("one,a,two,b", UNLIKE)
def test_unlike_keys_of_two_types_do_not_meet(spark, how, one, a, two, b):
    source = spark.createDataFrame([(a,)] * 6, "k string").select(F.col("k").cast(one))
    target = spark.createDataFrame([(b,)], "k string").select(F.col("k").cast(two))
    assert new_rows(source, target, ["k"], **WAYS[how]).count() == 6


@pytest.mark.parametrize("one,two", [("decimal(10,2)", "double"), ("boolean", "int"), ("array<int>", "string"), ("date", "int")])
def test_types_without_a_lossless_form_are_refused(spark, one, two):
    kinds = [spark.range(0).select(F.lit(None).cast(t).alias("k")).schema["k"].dataType for t in (one, two)]
    with pytest.raises(ValueError):
        normal_forms(*kinds)


def test_only_possible_hits_of_the_target_are_shuffled(spark):
    source = spark.range(0, 3000, 3).select(F.col("id").alias("k"))
    target = spark.range(0, 200000, 1, 4).select(F.col("id").alias("k"))
    left = possible_hits(target, source, ["k"])
    hits = target.join(source, "k").count()
    assert left.join(source, "k").count() == hits == 1000
    assert left.count() <= hits + 50
    options = {"broadcast_bytes": 0}
    for wanted in (source, source.limit(0), source.unionAll(spark.createDataFrame([(None,), (-5,)], "k long"))):
        with_filter = new_rows(wanted, target.where("k % 2 = 0"), ["k"], **options)
        without = new_rows(wanted, target.where("k % 2 = 0"), ["k"], key_filter=False, **options)
        assert sorted(map(str, with_filter.collect())) == sorted(map(str, without.collect()))
    plan = plan_of(with_filter)
    assert "bit_or" in plan and "BroadcastHashJoin" in plan


def test_a_source_too_large_for_the_filter_does_without(spark, monkeypatch):
    monkeypatch.setattr(merge, "FILTER_BITS", 64)
    source, target = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
    got = new_rows(source, target, ["k"], broadcast_bytes=0)
    assert "bit_or" not in plan_of(got) and got.count() == 50


def test_the_keys_are_measured_while_the_source_is_staged(spark, monkeypatch):
    table = register(
        spark, "tidegate_test", unique("seen"), fresh_path(spark, "seen"), [TableColumn("k", "bigint")]
    )
    asked = []
    monkeypatch.setattr(merge, "profile_keys", lambda *a: asked.append(a) or profile_keys(*a))
    merge_insert(spark, spark.range(10).withColumnRenamed("id", "k"), table, ["k"])
    assert not asked and spark.table(table).count() == 10
    merge_insert(spark, spark.range(20).withColumnRenamed("id", "k"), table, ["k"], broadcast_bytes=0)
    assert len(asked) == 1 and spark.table(table).count() == 20


def test_inserts_make_few_files(spark):
    table = register(
        spark, "tidegate_test", unique("files"), fresh_path(spark, "files"),
        [TableColumn("k", "bigint"), TableColumn("p", "bigint", True)],
    )
    source = spark.range(0, 4000, 1, 8).select(F.col("id").alias("k"), (F.col("id") % 8).alias("p"))
    merge_insert(spark, source, table, ["k"])
    assert spark.table(table).count() == 4000
    assert len(spark.table(table).inputFiles()) <= 8
