import pytest
from pyspark.sql import functions as F

from tests.plans import plan_of
from tidegate.operators import gates
from tidegate.operators import quality
from tidegate.operators.quality import OUTCOME_SCHEMA, failures, outcomes, outcomes_of_sets, staged_outcomes
from tidegate.spec import parse_rules
from tidegate.storage import stage


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(1, "a", 1.5), (1, "b", 2.0), (2, None, None), (None, "a", 2.0)],
        "id int, FONTE string, n double",
    )


def run(df, *rules, **options):
    return [tuple(r)[1:] for r in outcomes(df, parse_rules(rules), **options).collect()]


@pytest.mark.parametrize(
    "rule, want",
    [
        ("RowCount > 3", ("Passed", 4.0, None)),
        ("RowCount > 4", ("Failed", 4.0, "4 is not > 4")),
        ("RowCount >= 4", ("Passed", 4.0, None)),
        ("RowCount < 4", ("Failed", 4.0, "4 is not < 4")),
        ("RowCount <= 4", ("Passed", 4.0, None)),
        ("RowCount = 4", ("Passed", 4.0, None)),
        ('DistinctValuesCount "ID" > 1', ("Passed", 2.0, None)),
        ('DistinctValuesCount "id" = 3', ("Failed", 2.0, "2 is not = 3")),
        ('ColumnValues "fonte" in ["a", "b"]', ("Failed", 1.0, "1 rows outside the listed values")),
        ('ColumnValues "fonte" in []', ("Failed", 4.0, "4 rows outside the listed values")),
        ('ColumnValues "id" in [1, 2]', ("Failed", 1.0, "1 rows outside the listed values")),
        ('ColumnValues "id" in ["1", "2"]', ("Failed", 1.0, "1 rows outside the listed values")),
        ('ColumnValues "n" in [1.5, 2]', ("Failed", 1.0, "1 rows outside the listed values")),
        ('ColumnValues "fonte" in [1]', ("Failed", 4.0, "4 rows outside the listed values")),
        ('ColumnValues "gone" in ["a"]', ("Failed", None, "no such column: gone")),
        ('DistinctValuesCount "gone" > 1', ("Failed", None, "no such column: gone")),
    ],
)
def test_rules(frame, rule, want):
    assert run(frame, rule) == [want]


def test_outcomes_keep_the_order_and_text_of_the_rules(frame):
    rules = ["RowCount > 1", 'ColumnValues "fonte" in ["a"]', 'DistinctValuesCount "id" > 1', "RowCount < 1"]
    got = outcomes(frame, parse_rules(rules))
    assert got.schema.names == OUTCOME_SCHEMA.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in OUTCOME_SCHEMA]
    assert [r["rule"] for r in got.collect()] == rules
    assert failures(got).count() == 2


def test_no_rules_pass_with_no_rows(frame):
    got = outcomes(frame, [])
    assert got.schema == OUTCOME_SCHEMA and got.count() == 0
    assert tuple(gates.verdict(got).first()) == (0, True)


def test_empty_frame(frame):
    empty = frame.where("false")
    assert run(empty, 'ColumnValues "fonte" in ["a"]') == [("Passed", 0.0, None)]
    assert run(empty, "RowCount > 0", 'DistinctValuesCount "id" > 0') == [
        ("Failed", 0.0, "0 is not > 0"),
        ("Failed", 0.0, "0 is not > 0"),
    ]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("x",)], "`a.b c` string")
    assert run(df, 'ColumnValues "A.B C" in ["x"]', 'DistinctValuesCount "a.b c" = 1') == [
        ("Passed", 0.0, None),
        ("Passed", 1.0, None),
    ]


def test_estimates_on_request(spark):
    rows = spark.range(20000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    exact = run(rows, 'DistinctValuesCount "k" = 7', 'DistinctValuesCount "id" = 20000')
    assert [o[0] for o in exact] == ["Passed", "Passed"]
    rough = run(rows, 'DistinctValuesCount "id" > 18000', 'DistinctValuesCount "id" < 22000', approx_rsd=0.02)
    assert [o[0] for o in rough] == ["Passed", "Passed"]


def test_one_scan_of_the_named_columns_only(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    sets = {
        "a": parse_rules(["RowCount > 1", 'DistinctValuesCount "o_custkey" > 1']),
        "b": parse_rules(["RowCount < 1", 'ColumnValues "o_orderstatus" in ["F"]']),
    }
    plan = plan_of(outcomes_of_sets(df, sets))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan
    assert [r["rule_set"] for r in outcomes_of_sets(df, sets).collect()] == ["a", "a", "b", "b"]


@pytest.mark.parametrize(
    "passed, policy, flag, goes_on",
    [
        (True, "strict", True, True),
        (True, "strict", False, True),
        (False, "strict", True, False),
        (False, "strict", False, False),
        (True, "flags", False, True),
        (False, "flags", True, True),
        (False, "flags", False, False),
    ],
)
def test_gates(spark, passed, policy, flag, goes_on):
    assert gates.goes_on(passed, policy, flag) is goes_on
    row = spark.range(1).select(
        gates.read_action(F.lit(passed), F.lit(policy), F.lit(flag)),
        gates.write_action(F.lit(passed), F.lit(policy), F.lit(flag)),
    ).first()
    assert tuple(row) == (("read", "write") if goes_on else ("stop", "skip"))


COUNTS = ['DistinctValuesCount "id" > 1', 'DistinctValuesCount "fonte" = 2', 'DistinctValuesCount "n" > 5', "RowCount = 4"]


def test_distinct_counts_do_not_copy_rows(spark, frame):
    found = outcomes(frame, parse_rules(COUNTS))
    assert "Expand" not in plan_of(found)
    assert [tuple(r)[1:3] for r in found.collect()] == [("Passed", 2.0), ("Passed", 2.0), ("Failed", 2.0), ("Passed", 4.0)]
    assert "Expand" not in plan_of(outcomes(frame, parse_rules(COUNTS[1:2])))


def test_each_distinct_count_reads_its_column_alone(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rules = ['DistinctValuesCount "o_custkey" > 1', 'DistinctValuesCount "o_orderstatus" > 1']
    plan = plan_of(outcomes(orders, parse_rules(rules)))
    assert "ReadSchema: struct<o_custkey:bigint>" in plan and "ReadSchema: struct<o_orderstatus:string>" in plan


SETS = {"one": COUNTS, "two": ["RowCount < 2", 'ColumnValues "fonte" in ["a"]'], "none": [], "lost": ['ColumnValues "x" in [1]']}


@pytest.mark.parametrize("rsd", [None, 0.01])
@pytest.mark.parametrize("names", [("one",), ("two",), ("one", "two"), ("none",), ("lost", "two"), ("lost",)])
def test_outcomes_measured_while_staging_are_the_same(spark, frame, names, rsd):
    sets = {n: parse_rules(SETS[n]) for n in names}
    for df in (frame, frame.where("false")):
        held, found = staged_outcomes(df, sets, "quality-test", rsd)
        want = outcomes_of_sets(df, sets, rsd)
        assert found.columns == want.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
        assert sorted(map(str, held.frame.collect())) == sorted(map(str, df.collect()))
        held.release()


def test_rules_that_need_no_distinct_count_cost_no_scan(spark, frame, monkeypatch):
    staged = []
    monkeypatch.setattr(quality, "stage", lambda df, label: staged.append(plan_of(df)) or stage(df, label))
    _, found = staged_outcomes(frame, {"two": parse_rules(SETS["two"])}, "quality-test")
    assert "CollectMetrics" in staged[0] and len(staged) == 1
    assert "parquet" not in plan_of(found).lower() and "Scan Existing" not in plan_of(found)
