from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import (
    as_text,
    day_key,
    day_text,
    partition_json,
    partition_key,
    resolve,
    resolve_all,
    shifted_day,
)
from tidegate.functions.casts import lenient_cast
from tidegate.operators.casting import cast_to_columns
from tidegate.sources import TableColumn, map_type, scan_schema


def test_shifted_day():
    assert shifted_day(datetime(2024, 3, 1), -1, "%Y-%m-%d") == "2024-02-29"


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_days_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # A day that starts at one o'clock in Sao Paulo.
        df = spark.sql("SELECT TIMESTAMP_NTZ '2017-10-15 00:10:00' AS ts")
        assert tuple(df.select(day_key("ts"), day_text("ts")).first()) == (20171015, "20171015")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_resolve():
    assert resolve(["a", "B"], "b") == "B"
    assert resolve(["a", "A"], "A") == "A"
    assert resolve(["a"], "x") is None
    with pytest.raises(ValueError):
        resolve(["aB", "Ab"], "ab")
    with pytest.raises(ValueError):
        resolve_all(["a"], ["a", "b"])


def test_partition_texts(spark):
    df = spark.createDataFrame(
        [("2024", None, True, date(2024, 1, 2))], "year string, month string, hot boolean, day date"
    )
    columns = ["YEAR", "month", "hot", "day"]
    row = df.select(partition_key(df, columns), partition_json(df, columns)).first()
    assert row[0] == "year=2024#month=None#hot=True#day=2024-01-02"
    assert row[1] == '{"year":"2024","month":null,"hot":true,"day":"2024-01-02"}'
    row = df.select(partition_key(df, []), partition_json(df, [])).first()
    assert tuple(row) == ("", "{}")


def test_as_text_keeps_null(spark):
    df = spark.createDataFrame([(1, None, True)], "a int, b double, c boolean")
    assert as_text(df).dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert tuple(as_text(df).first()) == ("1", None, "true")


@pytest.mark.parametrize(
    "text, want",
    [
        ("string", T.StringType()),
        ("varchar(10)", T.StringType()),
        ("CHAR(3)", T.StringType()),
        ("int", T.IntegerType()),
        ("integer", T.IntegerType()),
        ("bigint", T.LongType()),
        ("boolean", T.BooleanType()),
        ("float", T.FloatType()),
        ("double", T.DoubleType()),
        ("timestamp", T.TimestampType()),
        ("date", T.DateType()),
        ("decimal(38,10)", T.DecimalType(38, 10)),
        ("Decimal(12, 2)", T.DecimalType(12, 2)),
        ("decimal", T.StringType()),
        ("tinyint", T.ByteType()),
        ("binary", T.BinaryType()),
        ("interval day", T.StringType()),
        ("array<int>", T.StringType()),
    ],
)
def test_type_map(spark, text, want):
    assert map_type(text) == want


def test_nested_types_can_be_kept(spark):
    assert map_type("array<int>", keep_nested=True) == T.ArrayType(T.IntegerType())
    assert map_type("tinyint", keep_nested=True) == T.ByteType()


def test_scan_schema_is_nullable():
    schema = scan_schema([TableColumn("a", "int"), TableColumn("p", "string", True)])
    assert [(f.name, f.nullable) for f in schema] == [("a", True), ("p", True)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cast_to_columns(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(
            [("7", "12.345", "x", [1], "k"), ("bad", "n/a", None, None, None)],
            "ID string, amount string, other string, list array<int>, `odd name` string",
        )
        cast = cast_to_columns(
            df,
            [
                TableColumn("amount", "decimal(10,2)"),
                TableColumn("id", "int"),
                TableColumn("list", "array<int>"),
                TableColumn("ODD NAME", "string"),
                TableColumn("absent", "int"),
            ],
        )
        assert cast.dtypes == [
            ("id", "int"),
            ("amount", "decimal(10,2)"),
            ("other", "string"),
            ("list", "string"),
            ("ODD NAME", "string"),
        ]
        assert [tuple(r) for r in cast.collect()] == [
            (7, Decimal("12.35"), "x", "[1]", "k"),
            (None, None, None, None, None),
        ]
        kept = cast_to_columns(df, [TableColumn("list", "array<bigint>")], keep_nested=True)
        assert kept.select("list").dtypes == [("list", "array<bigint>")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


TARGETS = ["int", "bigint", "double", "float", "boolean", "decimal(12,2)", "decimal(38,10)"]
TEXTS = [
    "", " ", "1", " 1 ", "\t-5\n", "+7", "--7", "1-URGENT", "12.5", ".5", "5.", ".", "1e3", "1E-3", "1e",
    "1d", "2.5F", "NaN", "nan", "inf", "-Infinity", "+INF", "infinite", "0x1p3", "0x", "2147483648",
    "99999999999999999999", "true", " T ", "yes", "Y", "no", "n", "f", "False", "0", "truth", "falsehood",
    "١٢", " 12", "1 2", "1,5", "\x001\x7f", "null", "1_000", " 1",
]


def _check_same(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for target in TARGETS:
        plain = F.col("t").try_cast(target)
        guarded = lenient_cast(F.col("t"), T.StringType(), target)
        different = df.where(~plain.cast("string").eqNullSafe(guarded.cast("string")))
        assert different.collect() == [], target


def test_guarded_casts_give_what_plain_ones_give(spark):
    _check_same(spark, TEXTS)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789+-.eEdDfFxXnNaAiItTyY \t\x00٣", max_size=8), min_size=40))
def test_guarded_casts_on_any_text(spark, texts):
    _check_same(spark, texts)
