"""Tests of the review's findings on the job operators."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidegate.operators import sinks
from tidegate.operators.maintenance import compact, stored_files
from tidegate.plans.queries import QUERIES

SETTING = sinks.OPEN_FILES_SETTING


@pytest.fixture
def settings(spark, monkeypatch):
    """What the setting is at each write by partition."""
    seen, by, write = [], DataFrameWriter.partitionBy, DataFrameWriter.parquet

    def partition_by(self, *columns):
        self.is_partitioned = True
        return by(self, *columns)

    def parquet(self, *args, **options):
        if getattr(self, "is_partitioned", False):
            seen.append(int(spark.conf.get(SETTING, "0")))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "partitionBy", partition_by)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_q26_sorts_no_rows_for_its_files(spark, settings):
    rows = QUERIES["q26_compaction"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 3 and all(r["fewer"] for r in rows)
    assert len(settings) == 2 and min(settings) > 0
    assert int(spark.conf.get(SETTING, "0")) == 0


def test_an_unsorted_write_has_no_sort(spark):
    spark.sql("CREATE TABLE unsorted_target (id BIGINT, p BIGINT) USING parquet PARTITIONED BY (p)")
    insert = "EXPLAIN INSERT INTO unsorted_target SELECT id, id % 3 FROM range(9)"
    try:
        assert "Sort" in spark.sql(insert).first()[0]
        with sinks.unsorted_writes(spark):
            assert "Sort" not in spark.sql(insert).first()[0]
    finally:
        spark.sql("DROP TABLE unsorted_target")


def test_the_setting_is_put_back(spark):
    spark.conf.set(SETTING, "40")
    try:
        with pytest.raises(KeyError), sinks.unsorted_writes(spark):
            assert spark.conf.get(SETTING) == "40"
            raise KeyError
        assert spark.conf.get(SETTING) == "40"
    finally:
        spark.conf.unset(SETTING)


def test_more_partitions_in_a_task_than_open_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "OPEN_FILES", 2)
    path = str(tmp_path / "many")
    rows = spark.range(4000).withColumn("p", F.when(F.col("id") % 7 < 6, F.col("id") % 7))
    rows.repartition(4).write.partitionBy("p").parquet(path)
    want = sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect()), key=str)
    with monkeypatch.context() as one_task:
        one_task.setattr("pyspark.sql.DataFrame.repartition", lambda self, n, *columns: self.coalesce(1))
        assert compact(spark, path, ["p"]) == 7
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "p").collect()), key=str) == want
    counts = stored_files(spark, path, ["p"]).groupBy("p").count().collect()
    assert len(counts) == 7 and {r["count"] for r in counts} == {1}
