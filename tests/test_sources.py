from datetime import datetime
from decimal import Decimal

import pytest

from tests.plans import plan_of
from tests.test_spec import dependency, raw
from tidegate.operators.merge import merge_insert
from tidegate.operators.sinks import register_partitions, write_csv, write_partitioned
from tidegate.plans.queries import register, unique
from tidegate.sources import (
    TableColumn,
    dated_name,
    expose_view,
    partition_columns,
    read_catalog,
    read_csv,
    read_dependency,
    read_parquet,
    scan_schema,
    table_columns,
)
from tidegate.spec import SpecError, parse_spec
from tidegate.storage import Lake, fresh_path, load_spec, load_sql, shared_folder, stage

COLUMNS = [
    TableColumn("id", "int"),
    TableColumn("amount", "decimal(10,2)"),
    TableColumn("name", "string"),
    TableColumn("day", "string", True),
]


def test_csv_rows_that_do_not_fit(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        '1,10.50,"a, b",20240101\n'
        "x,10.50,bad int,20240101\n"
        "3,much,bad amount,20240101\n"
        "4,1.00\n"
        "5,1.00,extra,20240101,more,fields\n"
        "6,,,\n"
    )
    rows = read_csv(spark, str(tmp_path / "f.csv"), scan_schema(COLUMNS)).collect()
    assert [tuple(r) for r in rows] == [
        (1, Decimal("10.50"), "a, b", "20240101"),
        (None, Decimal("10.50"), "bad int", "20240101"),
        (3, None, "bad amount", "20240101"),
        (4, Decimal("1.00"), None, None),
        (5, Decimal("1.00"), "extra", "20240101"),
        (6, None, None, None),
    ]


def test_csv_round_trip(spark):
    df = spark.createDataFrame(
        [(1, Decimal("1.25"), 'quote " and, comma', "d"), (2, None, None, None)],
        "id int, amount decimal(10,2), name string, day string",
    )
    path = fresh_path(spark, "csv-test")
    write_csv(df, path)
    assert sorted(read_csv(spark, path, scan_schema(COLUMNS)).collect()) == sorted(df.collect())


def test_dated_name():
    assert dated_name("A_%Y%m%d.csv", datetime(2024, 2, 1)) == "A_20240201.csv"
    assert dated_name("A_%Y-%m.csv", datetime(2024, 2, 1)) == "A_%Y-%m.csv"


def test_catalog_columns_and_scan(spark):
    path = fresh_path(spark, "catalog-test")
    df = spark.createDataFrame([(1, "x", 20240101), (2, "y", 20240102)], "id int, name string, day int")
    write_partitioned(df, path, ["day"])
    columns = [
        TableColumn("id", "int"),
        TableColumn("name", "varchar(5)"),
        TableColumn("day", "int", True),
    ]
    table = register(spark, "tidegate_test", unique("t"), path, columns)
    spark.sql(f"MSCK REPAIR TABLE {table}")
    found = table_columns(spark, table)
    assert [(c.name, c.is_partition) for c in found] == [(c.name, c.is_partition) for c in columns]
    assert scan_schema(found) == scan_schema(columns)
    assert partition_columns(spark, table) == ["day"]

    assert read_catalog(spark, table).count() == 2
    assert read_catalog(spark, table, "").count() == 2
    assert read_catalog(spark, table, "day > 20240101").first()["id"] == 2
    plan = plan_of(read_catalog(spark, table, "day > 20240101").select("id"))
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "ReadSchema: struct<id:int>" in plan
    for name in ("no_database", f"{table}.more"):
        with pytest.raises(SpecError):
            read_catalog(spark, name)


def test_a_date_filter_reaches_the_file_reader(spark):
    df = read_parquet(spark, "/root/testdata/sf0.001/events.parquet")
    plan = plan_of(df.where("ts >= '2024-01-28 00:00:00.000'").select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_view_names_ignore_case(spark):
    expose_view(spark.range(3), "tb_MixedCase")
    assert spark.sql("SELECT * FROM TB_MIXEDCASE").count() == 3


def test_each_dependency_gets_its_own_predicate(spark):
    frames = {}
    for name in ("tb_a", "tb_a_b"):
        path = fresh_path(spark, name)
        spark.range(5).toDF("day").write.parquet(path)
        register(spark, "tidegate_test", name, path)
    one = {"PushDown": "day = {}", "Type": "Date", "Filter": 0, "Pattern": "%d"}
    other = {**one, "Filter": 1}
    spec = parse_spec(
        raw(
            Dependencies=[
                dependency("tb_a", "tidegate_test", Predicate=[one]),
                dependency("tb_a_b", "tidegate_test", Predicate=[other]),
            ]
        )
    )
    for d in spec.dependencies:
        frames[d.table] = read_dependency(spark, spec, d, Lake.under("x"), datetime(2024, 1, 2))
    assert frames["tb_a"].first()["day"] == 2
    assert frames["tb_a_b"].first()["day"] == 3


def test_odd_table_names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tidegate_test")
    spark.sql("DROP TABLE IF EXISTS tidegate_test.`2024_orders`")
    path = fresh_path(spark, "odd")
    spark.sql(
        f"CREATE TABLE tidegate_test.`2024_orders` (id bigint, p int) USING parquet PARTITIONED BY (p) LOCATION '{path}'"
    )
    write_partitioned(spark.range(3).selectExpr("id", "1 AS p"), path, ["p"])
    register_partitions(spark, "tidegate_test.2024_orders")
    assert partition_columns(spark, "tidegate_test.2024_orders") == ["p"]
    assert read_catalog(spark, "tidegate_test.2024_orders", "p = 1").count() == 3
    merge_insert(spark, spark.range(5).selectExpr("id", "2 AS p"), "tidegate_test.2024_orders", ["id"])
    assert read_catalog(spark, "tidegate_test.2024_orders").count() == 5
    expose_view(spark.range(1), "2024-view")
    assert spark.sql("SELECT * FROM `2024-view`").count() == 1


def test_lake_paths():
    lake = Lake.under("/lake/")
    assert lake.target("CSV", "t") == lake.target("SOR", "t") == "/lake/sor/t"
    assert lake.target("SPEC", "t") == "/lake/spec/t"
    assert lake.landing_file("t", "f.csv") == "/lake/landing/t/f.csv"


def test_artefacts_are_read_through_spark(spark, tmp_path):
    import json

    folder = tmp_path / "artefacts" / "t"
    folder.mkdir(parents=True)
    (folder / "orchestration.json").write_text(json.dumps(raw(), indent=2))
    (folder / "sparksql.sql").write_text("SELECT 1 AS a\nFROM x")
    lake = Lake.under(str(tmp_path))
    assert load_spec(spark, lake, "t") == parse_spec(raw())
    assert load_sql(spark, lake, "t") == "SELECT 1 AS a\nFROM x"


def test_staged_tables_lie_in_the_folder_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    held = stage(spark.range(10), "test")
    assert held.path.startswith(shared_folder(spark))
    assert held.frame.count() == 10
    held.release()
