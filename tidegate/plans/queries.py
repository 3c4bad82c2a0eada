"""The registered queries: each exercises operators over whole test tables.

A query that is about a sink writes to a new path in the shared folder and returns what it reads back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.examples import example_spec, example_sql
from tidegate.functions import day_key, day_text, partition_key
from tidegate.operators import gates
from tidegate.operators.casting import cast_to_columns
from tidegate.operators.ledger import partitions, read_ledger, record
from tidegate.operators.maintenance import (
    catalog_partitions,
    compact,
    expired_partitions,
    orphan_partitions,
    stored_files,
)
from tidegate.operators.merge import merge_insert, new_rows
from tidegate.operators.quality import (
    STORED_OUTCOME_SCHEMA,
    failures,
    outcomes,
    outcomes_of_sets,
    stamp_outcomes,
)
from tidegate.operators.sinks import (
    add_partitions,
    put_keyed,
    read_keyed,
    unsorted_writes,
    write_csv,
    write_outcomes,
    write_partitioned,
)
from tidegate.operators.totals import Branch, tagged_totals, totals, union_rows
from tidegate.plans.job import run_job, run_merge, run_sql
from tidegate.sources import (
    TableColumn,
    dated_name,
    drop_view,
    expose_view,
    partition_columns,
    read_catalog,
    read_csv,
    read_dependency,
    read_parquet,
    scan_schema,
)
from tidegate.spec import JobSpec, Predicate, parse_rules, parse_spec, render_predicates
from tidegate.storage import Lake, fresh_path, stage

AS_OF = datetime(2024, 2, 1)
EVENTS_AS_OF = datetime(2024, 1, 30)

CSV_COLUMNS = [
    TableColumn("order_id", "bigint"),
    TableColumn("customer_id", "bigint"),
    TableColumn("status", "varchar(1)"),
    TableColumn("amount", "double"),
    TableColumn("order_day", "string"),
    TableColumn("priority", "string"),
]
TOTALS_COLUMNS = [
    TableColumn("contract_id", "string"),
    TableColumn("customer_id", "string"),
    TableColumn("valor", "double"),
    TableColumn("fonte", "string"),
    TableColumn("last_update_date", "timestamp"),
    TableColumn("data_processamento", "string", True),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def register(
    spark: SparkSession, database: str, name: str, path: str, columns: list[TableColumn] | None = None
) -> str:
    """An external catalog table over ``path``, new for this run."""
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{fresh_path(spark, database)}'"
    )
    identifier = f"{database}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {identifier}")
    if columns is None:
        spark.sql(f"CREATE TABLE {identifier} USING parquet LOCATION '{path}'")
        return identifier
    fields = ", ".join(f"{c.name} {c.type_text}" for c in columns)
    keys = ", ".join(c.name for c in columns if c.is_partition)
    by = f"PARTITIONED BY ({keys})" if keys else ""
    spark.sql(f"CREATE TABLE {identifier} ({fields}) USING parquet {by} LOCATION '{path}'")
    return identifier


def unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        day_text("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
    )


def daily_events(spark: SparkSession, sf_dir: str) -> str:
    """Events written by day, the layout the day predicates are for."""
    path = fresh_path(spark, "daily-events")
    rows = table(spark, sf_dir, "events").withColumn("anomesdia", day_key("ts"))
    write_partitioned(rows, path, ["anomesdia"])
    return path


def csv_scan(spark, sf_dir):
    path = fresh_path(spark, "csv")
    write_csv(landing_rows(spark, sf_dir), path)
    return read_csv(spark, path, scan_schema(CSV_COLUMNS))


def dated_file(spark, sf_dir):
    lake = Lake.under(fresh_path(spark, "dated"))
    write_csv(landing_rows(spark, sf_dir), lake.landing_file("landing_orders", "ORDERS_20240201.csv"))
    name = dated_name("ORDERS_%Y%m%d.csv", AS_OF)
    return read_csv(spark, lake.landing_file("landing_orders", name), scan_schema(CSV_COLUMNS))


def catalog_scan(spark, sf_dir):
    """Two dependencies, one name inside the other: each gets the predicate of its own."""
    name = unique("orders")
    for one in (name, f"{name}_old"):
        register(spark, "tidegate_check", one, f"{sf_dir}/orders.parquet")

    def dependency(table_name, template):
        return {
            "TableName": table_name,
            "DatabaseName": "tidegate_check",
            "Predicate": [
                {"PushDown": template, "Type": "Date", "Filter": -60, "Pattern": "%Y-%m-%d"}
            ],
            "Quality": {"Rules": [], "ReadIfFail": False},
        }

    spec = parse_spec(
        {
            "DataLayer": "SOT",
            "TableName": "t",
            "DatabaseName": "d",
            "Machine": {"Capacity": 2, "Type": "G.1X"},
            "Dependencies": [
                dependency(name, "o_orderdate >= '{} 00:00:00.000'"),
                dependency(f"{name}_old", "o_orderdate < '{} 00:00:00.000'"),
            ],
            "Quality": {"Rules": [], "WriteIfFail": False},
        }
    )
    as_of = datetime(2001, 8, 1)
    recent, old = [
        read_dependency(spark, spec, d, Lake.under("unused"), as_of) for d in spec.dependencies
    ]
    return recent.select("o_orderkey", F.lit("recent").alias("side")).unionAll(
        old.select("o_orderkey", F.lit("old").alias("side"))
    )


def parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")


def views(spark, sf_dir):
    for name in ("customer", "nation"):
        identifier = register(spark, "tidegate_check", unique(name), f"{sf_dir}/{name}.parquet")
        expose_view(read_catalog(spark, identifier), f"tb_{name.title()}")
    rows = spark.sql(
        """SELECT n_name, COUNT(*) AS n_customers FROM TB_CUSTOMER
           JOIN TB_NATION ON c_nationkey = n_nationkey GROUP BY n_name"""
    )
    for name in ("tb_Customer", "tb_Nation"):
        drop_view(spark, name)
    return rows


def partitioned_write(spark, sf_dir):
    lake = Lake.under(fresh_path(spark, "partitioned"))
    path = lake.target("SOR", "orders")
    columns = [
        TableColumn("o_orderkey", "bigint"),
        TableColumn("o_totalprice", "double"),
        TableColumn("last_update_date", "timestamp"),
        TableColumn("O_ORDERSTATUS", "string", True),
    ]
    identifier = register(spark, "tidegate_check", unique("orders"), path, columns)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_partitioned(rows, path, partition_columns(spark, identifier), AS_OF)
    return spark.read.parquet(path).select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        F.date_format("last_update_date", "yyyy-MM-dd HH:mm:ss").alias("written_at"),
    )


def partition_overwrite(spark, sf_dir):
    """All statuses written, then one of them again with other rows: the rest stays as it was."""
    path = fresh_path(spark, "overwrite")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    write_partitioned(rows, path, ["o_orderstatus"])
    again = rows.where("o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'")
    write_partitioned(again.withColumn("o_orderpriority", F.lit("NEW")), path, ["o_orderstatus"])
    return spark.read.parquet(path)


def keyed_upsert(spark, sf_dir):
    """Two batches put into a text table by user, the later one first: the last event of each user is what stays."""
    path = fresh_path(spark, "keyed")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
        "props",
    )
    batches = ((rows.where("ts >= '2024-01-16'"), AS_OF), (rows.where("ts < '2024-01-16'"), datetime(2024, 1, 16)))
    for batch, stamp in batches:
        put_keyed(batch, path, ["user_id"], ["ts", "event_id"], stamp)
    return read_keyed(spark, path, ["user_id"])


def partition_registration(spark, sf_dir):
    path = fresh_path(spark, "registration")
    columns = [TableColumn("o_orderkey", "bigint"), TableColumn("o_orderstatus", "string", True)]
    identifier = register(spark, "tidegate_check", unique("orders"), path, columns)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_partitioned(rows, path, ["o_orderstatus"])
    add_partitions(spark, identifier, rows, ["o_orderstatus"])
    return spark.table(identifier).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


def day_window(spark, sf_dir):
    path = daily_events(spark, sf_dir)
    spec = _windowed("anomesdia > {}", "anomesdia < {}", -10, "%Y%m%d")
    return spark.read.parquet(path).where(spec).select("event_id", "anomesdia")


def timestamp_window(spark, sf_dir):
    spec = _windowed("ts >= '{} 00:00:00.000'", "ts < '{} 23:59:59.000'", -2, "%Y-%m-%d")
    return table(spark, sf_dir, "events").where(spec).select("event_id", "user_id", "value")


def _windowed(low: str, high: str, days: int, pattern: str) -> str:
    return render_predicates(
        [Predicate(low, days, pattern), Predicate(high, 0, pattern)], EVENTS_AS_OF
    )


def cast_projection(spark, sf_dir):
    """Texts cast to a table's columns.  Half of the numbers do not parse and turn NULL."""
    texts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("ORDER_ID"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"))
        .otherwise(F.col("o_orderpriority"))
        .alias("Customer_Id"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.col("o_totalprice").alias("rough"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
        F.col("o_orderpriority").alias("untouched"),
    )
    columns = [
        TableColumn("order_id", "bigint"),
        TableColumn("customer_id", "int"),
        TableColumn("amount", "decimal(12, 2)"),
        TableColumn("rough", "float"),
        TableColumn("order_day", "date"),
        TableColumn("not_there", "string"),
    ]
    cast = cast_to_columns(texts, columns)
    return cast.select(
        "order_id",
        "customer_id",
        F.col("amount").cast("double").alias("amount"),
        F.col("rough").cast("double").alias("rough"),
        day_key("order_day").alias("order_day"),
        "untouched",
    )


def merge(spark, sf_dir):
    """Orders that are closed are known; all order keys and all line keys come in."""
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "merge")
    columns = [TableColumn("contract_id", "bigint"), TableColumn("origin", "string")]
    identifier = register(spark, "tidegate_check", unique("contracts"), path, columns)
    orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("contract_id"), F.lit("T").alias("origin")
    ).write.insertInto(identifier)
    source = (
        orders.select(F.lit("A").alias("origin"), F.col("o_orderkey").alias("CONTRACT_ID"))
        .unionAll(
            table(spark, sf_dir, "lineitem")
            .select(F.col("l_orderkey").alias("CONTRACT_ID"))
            .distinct()
            .select(F.lit("B").alias("origin"), "CONTRACT_ID")
        )
    )
    merge_insert(spark, source, identifier, ["contract_id"])
    return spark.table(identifier)


def merge_mixed_types(spark, sf_dir):
    """Line keys as decimals of 38 digits, order keys with 18 digits after the point: no type holds both.

    Keys of closed orders are known as they are, those of others with a half on top, which no line key equals.
    Sides are too large to broadcast, and keys of five lines and more take the path of hot keys.
    """
    lines = table(spark, sf_dir, "lineitem")
    source = lines.select(F.col("l_orderkey").cast("decimal(38,0)").alias("contract_id"), F.lit("S").alias("origin"))
    half = F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.lit(0.5)).cast("decimal(38,18)")
    known = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + half).cast("decimal(38,18)").alias("contract_id"), F.lit("T").alias("origin")
    )
    fresh = new_rows(source, known, ["contract_id"], broadcast_bytes=0, hot_share=0.0, hot_rows=5)
    return fresh.withColumn("contract_id", F.col("contract_id").cast("long"))


def two_databases(spark, sf_dir):
    """Two jobs with one table name in two databases and one input: both tables, ledger entries, outcomes."""
    lake = Lake.under(fresh_path(spark, "two-databases"))
    register(spark, "tidegate_sor", "tb_pair_orders", f"{sf_dir}/orders.parquet")
    columns = [
        TableColumn("status", "string"),
        TableColumn("n_orders", "bigint"),
        TableColumn("last_update_date", "timestamp"),
        TableColumn("day", "string", True),
    ]
    found = None
    for database, wanted in (("first", "'F'"), ("second", "'O', 'P'")):
        spec = parse_spec(
            {
                "DataLayer": "SOT",
                "TableName": "tb_pair",
                "DatabaseName": unique(f"tidegate_{database}"),
                "Machine": {"Capacity": 2, "Type": "G.1X"},
                "Dependencies": [
                    {
                        "TableName": "tb_pair_orders",
                        "DatabaseName": "tidegate_sor",
                        "Predicate": [],
                        "Quality": {"Rules": ["RowCount > 1"], "ReadIfFail": False},
                    }
                ],
                "Quality": {"Rules": ["RowCount > 0"], "WriteIfFail": False},
            }
        )
        register(spark, spec.database, spec.table, fresh_path(spark, "pair"), columns)
        sql = (
            "SELECT o_orderstatus AS status, COUNT(*) AS n_orders, DATE_FORMAT(:as_of, 'yyyyMMdd') AS day "
            f"FROM tb_pair_orders WHERE o_orderstatus IN ({wanted}) GROUP BY o_orderstatus"
        )
        for as_of in (EVENTS_AS_OF, AS_OF):
            run_job(spark, spec, lake, as_of, sql)
        entries = read_ledger(spark, lake.ledger).where(F.col("table_name") == spec.identifier)
        reader = spark.read.schema(STORED_OUTCOME_SCHEMA)
        kept = reader.parquet(f"{lake.outcomes}/predq").unionAll(reader.parquet(f"{lake.outcomes}/quality"))
        kept = kept.where(F.col("job") == spec.identifier)
        rows = (
            spark.table(spec.identifier).select(F.lit("row").alias("what"), "status", "day", F.col("n_orders").alias("n"))
            .unionAll(
                entries.groupBy("prtc_key").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit("entry"), F.lit(None).cast("string"), F.substring("prtc_key", 5, 8), "n")
            )
            .unionAll(
                kept.groupBy("anomesdia").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit("outcomes"), F.lit(None).cast("string"), "anomesdia", "n")
            )
            .withColumn("database", F.lit(database))
        )
        found = rows if found is None else found.unionAll(rows)
    return found


def order_totals(spark, sf_dir):
    rows = totals(
        table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], "o_totalprice", "total"
    )
    return rows.withColumn("total", F.col("total").cast("double"))


def text_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "amount_text", F.col("l_extendedprice").cast("string")
    )
    rows = totals(rows, ["l_orderkey", "l_suppkey"], "amount_text", "total")
    return rows.withColumn("total", F.col("total").cast("double"))


def daily_totals(spark, sf_dir):
    rows = totals(
        table(spark, sf_dir, "events"),
        ["event_type", "user_id", day_text("ts").alias("day")],
        "value",
        "total",
    )
    return rows.withColumn("total", F.col("total").cast("double"))


def contract_totals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.col("l_extendedprice").cast("string").alias("amount_text")
    )
    run_day = AS_OF.strftime("%Y%m%d")
    rows = tagged_totals(
        [
            Branch(
                table(spark, sf_dir, "orders"),
                "MAINFRAME", "o_orderkey", "o_custkey", "o_totalprice", run_day,
            ),
            Branch(lines, "MOBILE", "l_orderkey", "l_suppkey", "amount_text", run_day),
            Branch(
                table(spark, sf_dir, "events"),
                "EXTERNOS", "event_id", "user_id", "value", day_text("ts"),
            ),
        ]
    )
    return cast_to_columns(rows, TOTALS_COLUMNS)


def union_distinct(spark, sf_dir):
    """Keys of three sources as one set; a customer with many orders counts once."""
    orders = table(spark, sf_dir, "orders")
    return union_rows(
        orders.select(F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("mark")),
        table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag"),
        table(spark, sf_dir, "events").select("user_id", "event_type"),
    )


def union_sql(spark, sf_dir):
    """The same totals as ``contract_totals``, as SQL text over views."""
    for name in ("orders", "lineitem", "events"):
        expose_view(table(spark, sf_dir, name), f"tb_{name}")
    rows = cast_to_columns(run_sql(spark, example_sql("contract_totals"), AS_OF), TOTALS_COLUMNS)
    for name in ("orders", "lineitem", "events"):
        drop_view(spark, f"tb_{name}")
    return rows


def row_count_rules(spark, sf_dir):
    rules = parse_rules(
        ["RowCount > 1000", "RowCount < 10", "RowCount >= 1", "RowCount <= 0", "RowCount = 7"]
    )
    return outcomes(table(spark, sf_dir, "lineitem"), rules)


def distinct_rules(spark, sf_dir):
    rules = parse_rules(
        [
            'DistinctValuesCount "O_ORDERKEY" > 1',
            'DistinctValuesCount "o_orderstatus" = 3',
            'DistinctValuesCount "o_custkey" < 10',
        ]
    )
    return outcomes(table(spark, sf_dir, "orders"), rules)


def value_rules(spark, sf_dir):
    rules = parse_rules(
        [
            'ColumnValues "o_orderstatus" in ["F", "O", "P"]',
            'ColumnValues "o_orderstatus" in ["F", "O"]',
            'ColumnValues "no_such_column" in ["F"]',
        ]
    )
    return outcomes(table(spark, sf_dir, "orders"), rules)


ORDER_RULES = [
    "RowCount > 100",
    'DistinctValuesCount "o_orderkey" > 1',
    'DistinctValuesCount "o_custkey" > 1',
    'ColumnValues "o_orderstatus" in ["F", "O", "P"]',
    'ColumnValues "o_orderpriority" in ["1-URGENT", "2-HIGH"]',
]
EVENT_RULES = [
    "RowCount > 100",
    "RowCount < 10",
    'DistinctValuesCount "event_id" > 1',
    'ColumnValues "event_type" in ["click", "error", "purchase", "signup", "view"]',
]


def stored_outcomes(spark, sf_dir):
    root = fresh_path(spark, "outcomes")
    for name, rules in (("orders", ORDER_RULES), ("events", EVENT_RULES)):
        rows = stamp_outcomes(outcomes(table(spark, sf_dir, name), parse_rules(rules)), name, AS_OF)
        write_outcomes(rows, root, "predq", AS_OF)
    stored = spark.read.schema(STORED_OUTCOME_SCHEMA).parquet(f"{root}/predq")
    failed = failures(stored).groupBy("table_name").agg(F.count(F.lit(1)).alias("failed_rules"))
    return stored.drop("job").join(failed, "table_name", "left")


def gate_actions(spark, sf_dir):
    """Several rule sets, each under both policies and both values of its flag."""
    rows = None
    for name, rules in (("orders", ORDER_RULES), ("events", EVENT_RULES)):
        sets = {f"{name}_base": rules[:1], f"{name}_full": rules, f"{name}_none": []}
        found = outcomes_of_sets(
            table(spark, sf_dir, name), {k: parse_rules(v) for k, v in sets.items()}
        )
        rows = found if rows is None else rows.unionAll(found)
    cases = F.array(
        *[
            F.struct(F.lit(policy).alias("policy"), F.lit(flag).alias("flag"))
            for policy in gates.POLICIES
            for flag in (True, False)
        ]
    )
    cased = gates.verdict(rows, ["rule_set"]).select("*", F.inline(cases))
    write = gates.write_action(F.col("passed"), F.col("policy"), F.col("flag"))
    return cased.select(
        "rule_set",
        "failed_rules",
        "passed",
        "policy",
        "flag",
        gates.read_action(F.col("passed"), F.col("policy"), F.col("flag")).alias("on_read"),
        write.alias("on_write"),
        (write == gates.WRITE).alias("recorded"),
    )


def partition_keys(spark, sf_dir):
    columns = ["o_orderstatus", "o_orderpriority"]
    found = partitions(table(spark, sf_dir, "orders"), columns)
    return found.select(*columns, partition_key(found, columns).alias("prtc_key"))


def ledger_entries(spark, sf_dir):
    """The ledger knows one status, gets all, and gets all again on a later day."""
    path = fresh_path(spark, "ledger")
    orders = table(spark, sf_dir, "orders")
    closed = orders.where("o_orderstatus = 'F'")
    record(closed, path, "orders", ["o_orderstatus"], EVENTS_AS_OF)
    record(orders, path, "orders", ["o_orderstatus"], AS_OF)
    record(orders, path, "orders", ["o_orderstatus"], datetime(2024, 3, 1))
    return read_ledger(spark, path).select(
        "table_name",
        "prtc_key",
        "data_prtc",
        F.date_format("last_update_date", "yyyyMMdd").alias("added"),
    )


def compaction(spark, sf_dir):
    """Every task writes a file per partition, then the small files are brought together."""
    path = fresh_path(spark, "compaction")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    tasks = spark.sparkContext.defaultParallelism
    with unsorted_writes(spark):
        lines.repartition(tasks).write.partitionBy("l_returnflag").parquet(path)
    before = stage(_file_counts(spark, path), "files-before").frame
    compact(spark, path, ["l_returnflag"])
    after = _file_counts(spark, path).withColumnRenamed("n_files", "n_after")
    rows = spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("key_sum")
    )
    return (
        rows.join(before, "l_returnflag")
        .join(after, "l_returnflag")
        .select(
            "l_returnflag", "n_rows", "key_sum", (F.col("n_after") < F.col("n_files")).alias("fewer")
        )
    )


def _file_counts(spark, path):
    return (
        stored_files(spark, path, ["l_returnflag"])
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


def expiry(spark, sf_dir):
    """Days of each event type, from the catalog's list of partitions, against two cutoffs in one pass."""
    path = fresh_path(spark, "expiry")
    columns = [
        TableColumn("event_id", "bigint"),
        TableColumn("event_type", "string", True),
        TableColumn("anomesdia", "int", True),
    ]
    identifier = register(spark, "tidegate_check", unique("events"), path, columns)
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", day_key("ts").alias("anomesdia"))
    write_partitioned(rows, path, ["event_type", "anomesdia"])
    add_partitions(spark, identifier, rows, ["event_type", "anomesdia"])
    days = catalog_partitions(spark, identifier).select(
        F.col("event_type").alias("table_name"), F.col("anomesdia").cast("int").alias("anomesdia")
    )
    return expired_partitions(days, [20240115, 20240128], "anomesdia")


def orphans(spark, sf_dir):
    """Partitions that the catalog knows and the ledger was not told of."""
    path = daily_events(spark, sf_dir)
    columns = [TableColumn("event_id", "bigint"), TableColumn("anomesdia", "int", True)]
    identifier = register(spark, "tidegate_check", unique("events"), path, columns)
    written = spark.read.parquet(path)
    add_partitions(spark, identifier, written, ["anomesdia"])
    ledger = fresh_path(spark, "ledger")
    record(written.where("anomesdia <= 20240115"), ledger, "events", ["anomesdia"], AS_OF)
    found = catalog_partitions(spark, identifier)
    rows = orphan_partitions(found, "events", ["anomesdia"], read_ledger(spark, ledger))
    return rows.withColumn("table_name", F.lit("events"))


def ingest_job(spark, sf_dir):
    lake = Lake.under(fresh_path(spark, "ingest-job"))
    spec = _own_target(example_spec("landing_orders"))
    write_csv(landing_rows(spark, sf_dir), lake.landing_file(spec.table, "ORDERS_20240201.csv"))
    columns = [c for c in CSV_COLUMNS if c.name != "priority"] + [
        TableColumn("priority", "string", True)
    ]
    register(spark, spec.database, spec.table, lake.target(spec.layer, spec.table), columns)
    run_job(spark, spec, lake, AS_OF)
    return spark.table(spec.identifier)


def union_job(spark, sf_dir):
    _, spec = _union_job(spark, sf_dir, "contract_totals")
    return spark.table(spec.identifier).drop("last_update_date")


def gated_job(spark, sf_dir):
    """The result breaks a rule: outcomes are stored, nothing is written, nothing is recorded."""
    lake, spec = _union_job(spark, sf_dir, "contract_totals_gated")
    reader = spark.read.schema(STORED_OUTCOME_SCHEMA)
    stored = reader.parquet(f"{lake.outcomes}/predq").unionAll(
        reader.parquet(f"{lake.outcomes}/quality")
    )
    result = spark.table(spec.identifier).agg(F.count(F.lit(1)).alias("rows_written"))
    entries = read_ledger(spark, lake.ledger).agg(F.count(F.lit(1)).alias("entries"))
    stored = stored.withColumn("table_name", F.substring_index("table_name", ".", -1))
    found = stored.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rules"), F.count_if(F.col("outcome") == "Failed").alias("failed")
    )
    # Both are one row; the constant key joins them in the plan.
    one = F.lit(1).alias("one")
    return (
        found.select("*", one)
        .join(result.select("*", one), "one", "left")
        .join(entries.select("*", one), "one", "left")
        .drop("one")
    )


def _own_target(spec: JobSpec) -> JobSpec:
    """The spec with a target database of its own, so that runs in one session do not meet."""
    return replace(spec, database=unique(spec.database))


def _union_job(spark, sf_dir, name):
    lake = Lake.under(fresh_path(spark, name))
    spec = _own_target(example_spec(name))
    for source in ("orders", "lineitem", "events"):
        register(spark, "tidegate_sor", f"tb_{source}", f"{sf_dir}/{source}.parquet")
    register(spark, spec.database, spec.table, lake.target(spec.layer, spec.table), TOTALS_COLUMNS)
    run_job(spark, spec, lake, AS_OF, example_sql("contract_totals"))
    return lake, spec


def merge_job(spark, sf_dir):
    """Totals of three whole tables merged into a table that knows the contracts of closed orders."""
    sources = [
        register(spark, "tidegate_sor", f"tb_{name}", f"{sf_dir}/{name}.parquet")
        for name in ("orders", "lineitem", "events")
    ]
    columns = [c for c in TOTALS_COLUMNS if c.name != "last_update_date"]
    columns = [TableColumn(c.name, c.type_text) for c in columns]
    target = register(
        spark, "tidegate_sot", unique("contracts"), fresh_path(spark, "merge-job"), columns
    )
    table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").cast("string"),
        F.lit(None).cast("string"),
        F.lit(0.0),
        F.lit("KNOWN"),
        F.lit("20240101"),
    ).write.insertInto(target)
    run_merge(spark, sources, example_sql("contract_totals"), target, ["contract_id"], as_of=AS_OF)
    return spark.table(target)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_csv_scan": csv_scan,
    "q02_dated_file": dated_file,
    "q03_catalog_scan": catalog_scan,
    "q04_parquet_scan": parquet_scan,
    "q06_views": views,
    "q07_partitioned_write": partitioned_write,
    "q08_partition_overwrite": partition_overwrite,
    "q09_keyed_upsert": keyed_upsert,
    "q10_partition_registration": partition_registration,
    "q11_day_window": day_window,
    "q12_timestamp_window": timestamp_window,
    "q13_cast_projection": cast_projection,
    "q14_merge_insert": merge,
    "q14_merge_mixed_types": merge_mixed_types,
    "q15_order_totals": order_totals,
    "q16_text_totals": text_totals,
    "q17_contract_totals": contract_totals,
    "q17_union_distinct": union_distinct,
    "q17_union_sql": union_sql,
    "q18_daily_totals": daily_totals,
    "q19_row_count_rules": row_count_rules,
    "q20_distinct_rules": distinct_rules,
    "q21_value_rules": value_rules,
    "q22_stored_outcomes": stored_outcomes,
    "q23_gate_actions": gate_actions,
    "q24_partition_keys": partition_keys,
    "q25_ledger": ledger_entries,
    "q26_compaction": compaction,
    "q27_expiry": expiry,
    "q28_orphans": orphans,
    "q29_ingest_job": ingest_job,
    "q30_union_job": union_job,
    "q31_gated_job": gated_job,
    "q32_merge_job": merge_job,
    "q33_two_databases": two_databases,
}
