from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.plans import plan_of
from tidegate.functions import day_text
from tidegate.operators.totals import Branch, tagged_totals, totals, union_rows


def test_sums_of_texts_are_exact(spark):
    df = spark.createDataFrame(
        [("k", "0.1"), ("k", "0.2"), ("k", "12345678901234567890.0000000001"), ("k", "n/a"), (None, "1")],
        "key string, amount string",
    )
    got = {r["key"]: r["total"] for r in totals(df, ["key"], "amount", "total").collect()}
    assert got == {"k": Decimal("12345678901234567890.3000000001"), None: Decimal("1.0000000000")}
    assert totals(df, ["key"], "amount", "total").dtypes[1] == ("total", "decimal(38,10)")


def test_plain_sums_keep_their_type(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    assert totals(df, ["k"], "v", "s", exact=False).collect()[0]["s"] == 5


def test_keys_may_be_expressions(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 23:59:59' AS ts, 1 AS v")
    assert tuple(totals(df, [day_text("ts").alias("day")], "v", "s").first()) == (
        "20240101",
        Decimal("1.0000000000"),
    )


def test_union_rows_drops_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "a int, b string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (None, None)], "c int, d string")
    got = union_rows(a, b)
    assert got.columns == ["a", "b"]
    assert sorted(got.collect(), key=str) == sorted(
        spark.createDataFrame([(1, "x"), (2, "y"), (None, None)], "a int, b string").collect(), key=str
    )


def branches(spark, key_type="bigint"):
    one = spark.createDataFrame([(1, 7, 1.5), (1, 7, 2.5), (2, None, 1.0)], f"k {key_type}, c int, v double") \
        if key_type == "bigint" else spark.createDataFrame(
            [(1.0, 7, 1.5), (1.0, 7, 2.5), (2.0, None, 1.0)], "k double, c int, v double")
    two = spark.sql(
        "SELECT * FROM VALUES (1L, 7, '4', TIMESTAMP_NTZ '2024-01-01 05:00:00'),"
        " (1L, 7, '5', TIMESTAMP_NTZ '2024-01-02 05:00:00') AS t(k, c, v, ts)"
    )
    return [
        Branch(one, "ONE", "k", "c", "v", "20240201"),
        Branch(two, "TWO", "k", "c", "v", day_text("ts")),
    ]


def test_tagged_totals(spark):
    rows = [tuple(r) for r in tagged_totals(branches(spark)).collect()]
    assert sorted(rows, key=str) == sorted(
        [
            ("1", "7", Decimal("4.0000000000"), "ONE", "20240201"),
            ("2", None, Decimal("1.0000000000"), "ONE", "20240201"),
            ("1", "7", Decimal("4.0000000000"), "TWO", "20240101"),
            ("1", "7", Decimal("5.0000000000"), "TWO", "20240102"),
        ],
        key=str,
    )


def test_distinct_is_run_only_where_it_can_matter(spark):
    exact = plan_of(tagged_totals(branches(spark)))
    rough = plan_of(tagged_totals(branches(spark, "double")))
    assert exact.count("Exchange") == 2
    assert rough.count("Exchange") == 3


def test_tags_must_differ(spark):
    one = branches(spark)[0]
    with pytest.raises(ValueError):
        tagged_totals([one, one])


def test_only_needed_columns_are_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(totals(df, [F.col("o_custkey")], "o_totalprice", "s"))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    assert plan.count("Exchange") == 1
