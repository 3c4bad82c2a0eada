import json
import os
from datetime import datetime

import pytest

from tests.test_spec import dependency, raw
from tidegate.__main__ import main
from tidegate.operators.ledger import read_ledger
from tidegate.operators.quality import STORED_OUTCOME_SCHEMA
from tests.plans import plan_of
from tidegate.plans import job as jobs
from tidegate.plans.job import QualityStop, run_job, run_merge
from tidegate.plans.queries import register
from tidegate.sources import TableColumn
from tidegate.spec import SpecError, parse_spec
from tidegate.operators import quality
from tidegate.storage import Lake, fresh_path, shared_folder, stage

AS_OF = datetime(2024, 2, 1)
COLUMNS = [
    TableColumn("key", "string"),
    TableColumn("total", "decimal(12,2)"),
    TableColumn("last_update_date", "timestamp"),
    TableColumn("day", "string", True),
]
SQL = "SELECT K AS KEY, SUM(v) AS TOTAL, '20240201' AS DAY FROM TB_JOB_IN GROUP BY k"


@pytest.fixture
def lake(spark):
    lake = Lake.under(fresh_path(spark, "job-test"))
    path = fresh_path(spark, "job-input")
    spark.createDataFrame([("a", "1.5"), ("a", "2"), ("b", "3")], "k string, v string").write.parquet(path)
    register(spark, "tidegate_test", "tb_job_in", path)
    register(spark, "tidegate_test", "tb_job_out", lake.target("SOT", "tb_job_out"), COLUMNS)
    return lake


def spec(read_rules=(), rules=(), read_if_fail=False, write_if_fail=False):
    return parse_spec(
        raw(
            TableName="tb_job_out",
            DatabaseName="tidegate_test",
            Dependencies=[
                dependency(
                    "tb_job_in",
                    "tidegate_test",
                    Predicate=[],
                    Quality={"Rules": list(read_rules), "ReadIfFail": read_if_fail},
                )
            ],
            Quality={"Rules": list(rules), "WriteIfFail": write_if_fail},
        )
    )


def target(spark):
    return sorted((r["key"], float(r["total"]), r["day"]) for r in spark.table("tidegate_test.tb_job_out").collect())


def stored(spark, lake, phase):
    rows = spark.read.schema(STORED_OUTCOME_SCHEMA).parquet(f"{lake.outcomes}/{phase}").collect()
    return sorted((r["table_name"], r["anomesdia"], r["rule"], r["outcome"]) for r in rows)


WANT = [("a", 3.5, "20240201"), ("b", 3.0, "20240201")]


@pytest.mark.parametrize("staged", [True, False])
def test_a_job_that_passes_and_runs_again(spark, lake, staged):
    job = spec(["RowCount > 1"], ["RowCount = 2", 'ColumnValues "key" in ["a", "b"]'])
    for _ in range(2):
        report = run_job(spark, job, lake, AS_OF, SQL, staged=staged)
        assert report.written and report.reads == {"tb_job_in": "read"}
        assert target(spark) == WANT
        assert [r["prtc_key"] for r in read_ledger(spark, lake.ledger).collect()] == ["day=20240201"]
    assert stored(spark, lake, "predq") == [("tidegate_test.tb_job_in", "20240201", "RowCount > 1", "Passed")]
    assert len(stored(spark, lake, "quality")) == 2


def test_failed_inputs_stop_the_run(spark, lake):
    with pytest.raises(QualityStop) as stop:
        run_job(spark, spec(["RowCount > 1", "RowCount > 99"], read_if_fail=True), lake, AS_OF, SQL)
    assert stop.value.report.reads == {"tb_job_in": "stop"}
    assert not stop.value.report.written
    assert [r[3] for r in stored(spark, lake, "predq")] == ["Passed", "Failed"]
    assert target(spark) == []


def test_flags_let_a_failed_input_through(spark, lake):
    report = run_job(spark, spec(["RowCount > 99"], read_if_fail=True), lake, AS_OF, SQL, policy="flags")
    assert report.written and target(spark) == WANT
    with pytest.raises(QualityStop):
        run_job(spark, spec(["RowCount > 99"]), lake, AS_OF, SQL, policy="flags")


@pytest.mark.parametrize("flag", [True, False])
def test_a_failed_result_is_not_written(spark, lake, flag):
    report = run_job(spark, spec(rules=["RowCount < 2"], write_if_fail=flag), lake, AS_OF, SQL)
    assert not report.written
    assert target(spark) == [] and read_ledger(spark, lake.ledger).count() == 0
    assert [r[3] for r in stored(spark, lake, "quality")] == ["Failed"]


def test_flags_let_a_failed_result_through(spark, lake):
    report = run_job(
        spark, spec(rules=["RowCount < 2"], write_if_fail=True), lake, AS_OF, SQL, policy="flags"
    )
    assert report.written and target(spark) == WANT


def test_unknown_policy_and_missing_sql(spark, lake):
    with pytest.raises(ValueError):
        run_job(spark, spec(), lake, AS_OF, SQL, policy="lax")
    with pytest.raises(ValueError):
        run_job(spark, spec(), lake, AS_OF)


def test_nothing_staged_is_left_behind(spark, lake):
    before = set(os.listdir(f"{shared_folder(spark)}/tidegate"))
    run_job(spark, spec(), lake, AS_OF, SQL)
    made = set(os.listdir(f"{shared_folder(spark)}/tidegate")) - before
    assert not [name for name in made if name.startswith("tb_job_out")]


def test_landing_job(spark, tmp_path):
    lake = Lake.under(str(tmp_path))
    folder = tmp_path / "landing" / "tb_landed"
    folder.mkdir(parents=True)
    (folder / "IN_20240201.csv").write_text("a,1.50,x\nb,oops,y\nc\n")
    columns = [TableColumn("key", "string"), TableColumn("total", "decimal(12,2)"), TableColumn("p", "string", True)]
    register(spark, "tidegate_test", "tb_landed", lake.target("CSV", "tb_landed"), columns)
    job = parse_spec(
        raw(
            DataLayer="CSV",
            TableName="tb_landed",
            DatabaseName="tidegate_test",
            Dependencies=[
                dependency(
                    "IN_%Y%m%d.csv", "", Predicate=[], Quality={"Rules": ["RowCount = 3"], "ReadIfFail": False}
                )
            ],
            Quality={"Rules": ['ColumnValues "key" in ["a", "b", "c"]'], "WriteIfFail": False},
        )
    )
    report = run_job(spark, job, lake, AS_OF)
    assert report.written and report.path.endswith(lake.target("SOR", "tb_landed"))
    rows = spark.table("tidegate_test.tb_landed").collect()
    assert sorted((r["key"], str(r["total"]), r["p"]) for r in rows) == [
        ("a", "1.50", "x"),
        ("b", "None", "y"),
        ("c", "None", None),
    ]
    assert stored(spark, lake, "predq")[0][0] == "IN_%Y%m%d.csv"


def test_outcome_tables_are_registered_where_they_exist(spark, lake):
    columns = [
        TableColumn(f.name, f.dataType.simpleString(), f.name in ("table_name", "anomesdia", "job"))
        for f in STORED_OUTCOME_SCHEMA
    ]
    register(spark, "tidegate_test", "predq_seen", f"{lake.outcomes}/predq", columns)
    run_job(
        spark, spec(["RowCount > 1"]), lake, AS_OF, SQL,
        outcome_tables=("tidegate_test.predq_seen", "tidegate_test.not_there"),
    )
    assert spark.table("tidegate_test.predq_seen").count() == 1


def test_a_job_is_run_from_its_artefacts(spark, tmp_path, capsys):
    lake = Lake.under(str(tmp_path))
    folder = tmp_path / "artefacts" / "tb_job_out"
    folder.mkdir(parents=True)
    job = raw(
        TableName="tb_job_out",
        DatabaseName="tidegate_test",
        Dependencies=[dependency("tb_job_in", "tidegate_test", Predicate=[])],
        Quality={"Rules": ["RowCount = 2"], "WriteIfFail": False},
    )
    (folder / "orchestration.json").write_text(json.dumps(job))
    (folder / "sparksql.sql").write_text(SQL)
    path = fresh_path(spark, "job-input")
    spark.createDataFrame([("a", "1.5"), ("a", "2"), ("b", "3")], "k string, v string").write.parquet(path)
    register(spark, "tidegate_test", "tb_job_in", path)
    register(spark, "tidegate_test", "tb_job_out", lake.target("SOT", "tb_job_out"), COLUMNS)
    main(["--table_name", "tb_job_out", "--lake", str(tmp_path), "--as_of", "2024-02-01"])
    assert "tb_job_out: write" in capsys.readouterr().out
    assert target(spark) == WANT


def test_views_end_with_the_job(spark, lake):
    run_job(spark, spec(), lake, AS_OF, SQL)
    free = parse_spec(raw(TableName="tb_job_out", DatabaseName="tidegate_test", Dependencies=[]))
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        run_job(spark, free, lake, AS_OF, SQL)


def test_a_taken_view_name_is_refused(spark, lake):
    spark.range(1).createOrReplaceTempView("TB_JOB_IN")
    try:
        with pytest.raises(SpecError):
            run_job(spark, spec(), lake, AS_OF, SQL)
    finally:
        spark.catalog.dropTempView("TB_JOB_IN")
    assert target(spark) == []


def test_rows_go_where_the_catalog_says(spark, lake):
    other = fresh_path(spark, "elsewhere")
    register(spark, "tidegate_test", "tb_job_out", other, COLUMNS)
    report = run_job(spark, spec(), lake, AS_OF, SQL)
    assert report.path.endswith(other.removeprefix("file:")) and target(spark) == WANT


@pytest.mark.parametrize("kind", ["smallint", "tinyint", "timestamp_ntz", "binary"])
def test_plain_target_types_are_read_back(spark, lake, kind):
    columns = [TableColumn("key", kind), *COLUMNS[1:]]
    register(spark, "tidegate_test", "tb_job_out", fresh_path(spark, "typed"), columns)
    sql = f"SELECT CAST({'current_timestamp()' if 'time' in kind else repr('7')} AS STRING) AS key, 1 AS total, 'd' AS day"
    assert run_job(spark, spec(), lake, AS_OF, sql).written
    assert spark.table("tidegate_test.tb_job_out").first()["key"] is not None


def test_nested_targets_are_refused_unless_kept(spark, lake):
    columns = [TableColumn("key", "array<int>"), *COLUMNS[1:]]
    register(spark, "tidegate_test", "tb_job_out", fresh_path(spark, "nested"), columns)
    sql = "SELECT array(1, 2) AS key, 1 AS total, 'd' AS day"
    with pytest.raises(SpecError):
        run_job(spark, spec(), lake, AS_OF, sql)
    assert run_job(spark, spec(), lake, AS_OF, sql, keep_nested=True).written
    assert spark.table("tidegate_test.tb_job_out").first()["key"] == [1, 2]


def test_merge_sources_need_names_of_their_own(spark):
    with pytest.raises(ValueError):
        run_merge(spark, ["a.t", "b.T"], "SELECT 1", "c.t", ["k"])


def test_the_result_is_shuffled_once_and_written_as_it_lies(spark, lake, monkeypatch):
    staged, written = [], []
    write = jobs.write_partitioned
    monkeypatch.setattr(quality, "stage", lambda df, label: staged.append(plan_of(df)) or stage(df, label))
    monkeypatch.setattr(jobs, "write_partitioned", lambda df, *a, **k: (written.append((plan_of(df), k)), write(df, *a, **k)))
    sql = "SELECT K AS KEY, v AS TOTAL, '20240201' AS DAY FROM TB_JOB_IN"
    run_job(spark, spec(rules=["RowCount = 3"]), lake, AS_OF, sql)
    assert staged[0].count("Exchange") == 1 and "CollectMetrics" in staged[0]
    assert [("Exchange" in plan, options) for plan, options in written] == [(False, {"balance": False})]
    assert spark.table("tidegate_test.tb_job_out").count() == 3


def several(read_rules):
    return parse_spec(
        raw(
            TableName="tb_job_out",
            DatabaseName="tidegate_test",
            Dependencies=[
                dependency(f"tb_job_in_{i}", "tidegate_test", Predicate=[], Quality={"Rules": rules, "ReadIfFail": False})
                for i, rules in enumerate(read_rules)
            ],
            Quality={"Rules": [], "WriteIfFail": False},
        )
    )


def test_rules_of_all_inputs_are_one_plan_and_one_write(spark, lake, monkeypatch):
    writes = []
    write = jobs.write_outcomes
    monkeypatch.setattr(jobs, "write_outcomes", lambda rows, *a: (writes.append(rows.count()), write(rows, *a)))
    path = fresh_path(spark, "job-input")
    spark.createDataFrame([("a", "1.5"), ("b", "3")], "k string, v string").write.parquet(path)
    for i in range(4):
        register(spark, "tidegate_test", f"tb_job_in_{i}", path)
    sql = "SELECT k AS key, v AS total, '20240201' AS day FROM tb_job_in_0"
    good = ["RowCount > 1", 'DistinctValuesCount "k" = 2', 'DistinctValuesCount "v" = 2']
    assert run_job(spark, several([good, [], good, ["RowCount = 2"]]), lake, AS_OF, sql).written
    assert writes == [7]
    with pytest.raises(QualityStop, match="tb_job_in_1") as stop:
        run_job(spark, several([good, ["RowCount = 5"], ["RowCount = 7"]]), lake, AS_OF, sql)
    assert writes == [7, 4] and stop.value.report.reads == {"tb_job_in_0": "read", "tb_job_in_1": "stop"}
