"""Time the registered queries; one JSON line on stdout.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` pick the data and the cores.  ``baselines`` holds the plain way to
do the same work, timed in the same session: one pass per rule, one grouped branch after another with a
distinct on top, a whole-table rewrite, and a merge that takes the target's rows as they are.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidegate.functions import day_text
from tidegate.operators.quality import outcomes
from tidegate.operators.sinks import write_partitioned
from tidegate.operators.totals import totals
from tidegate.plans.queries import EVENT_RULES, ORDER_RULES, QUERIES, table
from tidegate.spec import parse_rules
from tidegate.storage import fresh_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ("q08_partition_overwrite", "q14_merge_insert", "q17_contract_totals", "q22_stored_outcomes")
REPEATS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidegate-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        # Tables of a few MB: keep what one task writes small too, so that all cores have work.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidegate-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(make, repeats: int) -> float:
    """Best of ``repeats`` runs, all rows computed and dropped."""
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def rule_by_rule(spark):
    frames = [
        outcomes(table(spark, SF_DIR, name), parse_rules([rule]))
        for name, rules in (("orders", ORDER_RULES), ("events", EVENT_RULES))
        for rule in rules
    ]
    for frame in frames[1:]:
        frames[0] = frames[0].unionAll(frame)
    return frames[0]


def stored_rule_by_rule(spark):
    path = fresh_path(spark, "plain-outcomes")
    rule_by_rule(spark).write.parquet(path)
    return spark.read.parquet(path)


def one_pass(spark):
    rows = [
        outcomes(table(spark, SF_DIR, name), parse_rules(rules))
        for name, rules in (("orders", ORDER_RULES), ("events", EVENT_RULES))
    ]
    return rows[0].unionAll(rows[1])


def union_then_distinct(spark):
    def branch(name, key, party, amount, tag, day):
        rows = table(spark, SF_DIR, name).withColumn("_amount", F.col(amount).cast("string"))
        rows = totals(rows, [key, party, day.alias("day")], "_amount", "total")
        return rows.select(
            F.col(key).cast("string"), F.col(party).cast("string"),
            F.col("total").cast("double"), F.lit(tag), "day",
        )

    run_day = F.lit("20240201")
    return (
        branch("orders", "o_orderkey", "o_custkey", "o_totalprice", "MAINFRAME", run_day)
        .union(branch("lineitem", "l_orderkey", "l_suppkey", "l_extendedprice", "MOBILE", run_day))
        .union(branch("events", "event_id", "user_id", "value", "EXTERNOS", day_text("ts")))
        .distinct()
    )


def whole_rewrite(spark):
    rows = table(spark, SF_DIR, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    first, second = fresh_path(spark, "rewrite"), fresh_path(spark, "rewrite")
    write_partitioned(rows, first, ["o_orderstatus"])
    changed = rows.where("o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'").withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "P", F.lit("NEW")).otherwise(F.col("o_orderpriority")),
    )
    write_partitioned(changed, second, ["o_orderstatus"], overwrite="static")
    return spark.read.parquet(second)


def plain_merge(spark):
    orders = table(spark, SF_DIR, "orders")
    target = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("contract_id"), F.lit("T").alias("origin")
    )
    lines = table(spark, SF_DIR, "lineitem").select(F.col("l_orderkey").alias("contract_id")).distinct()
    source = (
        orders.select(F.col("o_orderkey").alias("contract_id"), F.lit("A").alias("origin"))
        .unionAll(lines.withColumn("origin", F.lit("B")))
    )
    path = fresh_path(spark, "plain-merge")
    target.write.parquet(path)
    known = spark.read.parquet(path)
    source.join(known, "contract_id", "left_anti").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    spark = session()
    registered = QUERIES
    warm = "/root/testdata/sf0.001"
    for name, make in registered.items():
        if os.path.isdir(warm):
            make(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name, make in registered.items():
        alike = name in HEADLINE or name.startswith("q17")
        times[name] = timed(lambda: make(spark, SF_DIR), REPEATS if alike else 1)
        print(f"{name} {times[name]}", file=sys.stderr)
    baselines = {
        "q08_whole_rewrite": timed(lambda: whole_rewrite(spark), REPEATS),
        "q14_plain_merge": timed(lambda: plain_merge(spark), REPEATS),
        "q17_union_then_distinct": timed(lambda: union_then_distinct(spark), REPEATS),
        "q22_rule_by_rule": timed(lambda: rule_by_rule(spark), REPEATS),
        "q22_rule_by_rule_stored": timed(lambda: stored_rule_by_rule(spark), REPEATS),
        "q22_one_pass": timed(lambda: one_pass(spark), REPEATS),
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times[n] for n in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "baselines": baselines,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
