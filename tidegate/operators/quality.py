"""Quality rules as one aggregation over the frame, or measured while the frame is staged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.casts import lenient_cast
from tidegate.functions.names import quoted, resolve
from tidegate.spec import Rule
from tidegate.storage import Staged, empty_frame, stage

PASSED = "Passed"
FAILED = "Failed"

OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("actual", T.DoubleType()),
        T.StructField("failure_reason", T.StringType()),
    ]
)

STORED_OUTCOME_SCHEMA = (
    T.StructType(list(OUTCOME_SCHEMA.fields))
    .add("table_name", T.StringType())
    .add("anomesdia", T.StringType())
    .add("job", T.StringType())
)

_COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
}


def outcomes(df: DataFrame, rules: Sequence[Rule], approx_rsd: float | None = None) -> DataFrame:
    """One row per rule.  An empty rule list gives no row."""
    return outcomes_of_sets(df, {"": rules}, approx_rsd).drop("rule_set")


def outcomes_of_sets(
    df: DataFrame, rule_sets: Mapping[str, Sequence[Rule]], approx_rsd: float | None = None
) -> DataFrame:
    """Outcomes of several named rule sets over the same frame.

    Only the columns the rules name are read.  Rules that ask for the same number share it.
    ``approx_rsd`` replaces exact distinct counts by estimates with that relative error, for wide
    rule sets on large frames; exact is the default.

    A frame is scanned once, and once more for each column but one whose values are counted exactly.
    """
    asked = _asked(df, rule_sets, approx_rsd)
    if not asked.rows:
        return _no_outcomes(df.sparkSession)
    return asked.outcomes(_measured(df, asked.metrics))


def staged_outcomes(
    df: DataFrame, rule_sets: Mapping[str, Sequence[Rule]], label: str, approx_rsd: float | None = None
) -> tuple[Staged, DataFrame]:
    """``df`` as a staged table, and the outcomes of rule sets over it, measured while it is written.

    Only exact counts of distinct values can't be watched on the way; these read their column of the staged table.
    """
    asked = _asked(df, rule_sets, approx_rsd)
    watched = {n: c for n, (c, exact) in asked.metrics.items() if not exact}
    spark = df.sparkSession
    if not watched:
        held = stage(df, label)
        values = {}
    else:
        seen = Observation()
        held = stage(df.observe(seen, *[c.alias(n) for n, c in watched.items()]), label)
        values = seen.get
    if not asked.rows:
        return held, _no_outcomes(spark)
    measured = spark.range(1).select([F.lit(values[n]).cast("long").alias(n) for n in watched])
    counted = {n: m for n, m in asked.metrics.items() if n not in watched}
    if counted:
        measured = _side_by_side([measured, *_counts(held.frame, counted)], list(asked.metrics))
    return held, asked.outcomes(measured)


@dataclass(frozen=True)
class Asked:
    """Numbers that rules ask for, by name, each with whether it is an exact distinct count; and outcome rows."""

    metrics: dict[str, tuple[Column, bool]]
    rows: list[Column]

    def outcomes(self, measured: DataFrame) -> DataFrame:
        return measured.select(F.inline(F.array(*self.rows)))


def _asked(df: DataFrame, rule_sets: Mapping[str, Sequence[Rule]], approx_rsd: float | None) -> Asked:
    metrics: dict[tuple, Column] = {}
    rows = [_outcome(df, name, rule, metrics, approx_rsd) for name, rules in rule_sets.items() for rule in rules]
    exact = approx_rsd is None
    return Asked({_metric_name(k, metrics): (c, exact and k[0] == "distinct") for k, c in metrics.items()}, rows)


def _measured(df: DataFrame, metrics: Mapping[str, tuple[Column, bool]]) -> DataFrame:
    """One row with all numbers.

    Several exact distinct counts in one aggregation would copy each row once a column.  So all but the first have
    an aggregation of their own, which reads one column and folds its values before they are shuffled.
    """
    if not metrics:
        return df.sparkSession.range(1)
    exact = [n for n, (_, is_exact) in metrics.items() if is_exact]
    apart = {n: metrics[n] for n in exact[1:]}
    together = df.agg(*[c.alias(n) for n, (c, _) in metrics.items() if n not in apart])
    if not apart:
        return together
    return _side_by_side([together, *_counts(df, apart)], list(metrics))


def _counts(df: DataFrame, metrics: Mapping[str, tuple[Column, bool]]) -> list[DataFrame]:
    return [df.agg(column.alias(name)) for name, (column, _) in metrics.items()]


def _side_by_side(frames: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Frames of one row, each with some of the numbers, as one row with all of them."""
    rows = None
    for frame in frames:
        whole = frame.select([(F.col(n) if n in frame.columns else F.lit(None)).cast("long").alias(n) for n in names])
        rows = whole if rows is None else rows.unionAll(whole)
    return rows.agg(*[F.max(n).alias(n) for n in names])


def _no_outcomes(spark: SparkSession) -> DataFrame:
    return empty_frame(spark, T.StructType([T.StructField("rule_set", T.StringType()), *OUTCOME_SCHEMA.fields]))


def outcome_frame(spark: SparkSession, rows: Sequence[Row]) -> DataFrame:
    """Outcomes that came to the driver as a frame again: constants, no Python worker is started."""
    if not rows:
        return empty_frame(spark, OUTCOME_SCHEMA)
    made = [
        F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in OUTCOME_SCHEMA])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*made)))


def stamp_outcomes(df: DataFrame, table_name: str, as_of: datetime, job: str | None = None) -> DataFrame:
    """Outcomes with the table they are about, the day of the run and the job that asked (by its target)."""
    return df.withColumns(
        {
            "table_name": F.lit(table_name),
            "anomesdia": F.lit(as_of.strftime("%Y%m%d")),
            "job": F.lit(job or table_name),
        }
    )


def failures(outcome_rows: DataFrame) -> DataFrame:
    return outcome_rows.where(F.col("outcome") == FAILED)


def _outcome(df, set_name, rule, metrics, approx_rsd) -> Column:
    column = None
    if rule.column is not None:
        column = resolve(df.columns, rule.column)
        if column is None:
            return _row(
                set_name,
                rule,
                F.lit(FAILED),
                F.lit(None).cast("double"),
                F.lit(f"no such column: {rule.column}"),
            )
    if rule.kind == "values":
        actual = _metric(metrics, ("outside", column, rule.values), lambda: _outside(df, column, rule))
        passed = actual == 0
        reason = F.concat(actual.cast("string"), F.lit(" rows outside the listed values"))
    else:
        if rule.kind == "rows":
            actual = _metric(metrics, ("rows",), lambda: F.count(F.lit(1)))
        else:
            actual = _metric(metrics, ("distinct", column), lambda: _distinct(column, approx_rsd))
        passed = _COMPARE[rule.comparator](actual, F.lit(rule.bound))
        reason = F.concat(actual.cast("string"), F.lit(f" is not {rule.comparator} {rule.bound}"))
    return _row(
        set_name,
        rule,
        F.when(passed, F.lit(PASSED)).otherwise(F.lit(FAILED)),
        actual.cast("double"),
        F.when(~passed, reason),
    )


def _row(set_name, rule, outcome, actual, reason) -> Column:
    return F.struct(
        F.lit(set_name).alias("rule_set"),
        F.lit(rule.text).alias("rule"),
        outcome.alias("outcome"),
        actual.alias("actual"),
        reason.cast("string").alias("failure_reason"),
    )


def _metric(metrics, key, build) -> Column:
    if key not in metrics:
        metrics[key] = build()
    return F.col(_metric_name(key, metrics))


def _metric_name(key, metrics) -> str:
    return f"metric_{list(metrics).index(key)}"


def _distinct(column: str, approx_rsd: float | None) -> Column:
    if approx_rsd is None:
        return F.count_distinct(F.col(quoted(column)))
    return F.approx_count_distinct(F.col(quoted(column)), approx_rsd)


def _outside(df: DataFrame, column: str, rule: Rule) -> Column:
    """Rows whose value is not listed.  NULL is not listed."""
    value = F.col(quoted(column))
    texts = [v for v in rule.values if isinstance(v, str)]
    numbers = [v for v in rule.values if not isinstance(v, str)]
    listed = F.lit(False)
    if texts:
        listed = listed | F.coalesce(value.cast("string").isin(texts), F.lit(False))
    if numbers:
        if not isinstance(df.schema[column].dataType, T.NumericType):
            value = lenient_cast(value, df.schema[column].dataType, T.DoubleType())
        listed = listed | F.coalesce(value.isin(numbers), F.lit(False))
    return F.count_if(~listed)
