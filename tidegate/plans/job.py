"""One job: read and check its inputs, run its SQL, check the result, write, record, register."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession

from tidegate.functions.names import quoted_table
from tidegate.operators import gates
from tidegate.operators.casting import cast_to_columns
from tidegate.operators.ledger import record
from tidegate.operators.merge import merge_insert
from tidegate.operators.quality import PASSED, outcome_frame, outcomes_of_sets, staged_outcomes, stamp_outcomes
from tidegate.operators.sinks import (
    add_partitions,
    balanced,
    register_partitions,
    write_outcomes,
    write_partitioned,
)
from tidegate.sources.scans import drop_view, expose_view, read_catalog, read_dependency, refuse_taken
from tidegate.sources.schema import check_writable, partition_columns, table_columns, table_location
from tidegate.spec import Dependency, JobSpec, Rule
from tidegate.storage import Lake, load_spec, load_sql

OUTCOME_TABLES = ("sor.predq", "sor.quality")
READ_PHASE, RESULT_PHASE = "predq", "quality"


@dataclass
class RunReport:
    table: str
    path: str
    reads: dict[str, str] = field(default_factory=dict)
    outcomes: dict[str, list[Row]] = field(default_factory=dict)
    write: str = gates.SKIP

    @property
    def written(self) -> bool:
        return self.write == gates.WRITE


class QualityStop(RuntimeError):
    """An input failed its rules; the run ends before anything of the result is made."""

    def __init__(self, message: str, report: RunReport):
        super().__init__(message)
        self.report = report


def run_job(
    spark: SparkSession,
    spec: JobSpec,
    lake: Lake,
    as_of: datetime,
    sql: str | None = None,
    policy: str = "strict",
    overwrite: str = "dynamic",
    keep_nested: bool = False,
    staged: bool = True,
    approx_rsd: float | None = None,
    outcome_tables: Sequence[str] = OUTCOME_TABLES,
) -> RunReport:
    """Run ``spec`` as of a point in time.

    With ``staged`` the result is computed once, into a staged table; rules, write and ledger read
    that.  Turn it off where the result is a cheap projection of its inputs and a second scan of those
    costs less than a second write, but never for a job that reads its own target.
    """
    if policy not in gates.POLICIES:
        raise ValueError(f"policy must be one of {gates.POLICIES}, not {policy!r}")
    columns = table_columns(spark, spec.identifier)
    check_writable(columns, keep_nested)
    path = table_location(spark, spec.identifier) or lake.target(spec.layer, spec.table)
    report = RunReport(spec.table, path)
    landing = spec.layer == "CSV"
    if not landing:
        refuse_taken(spark, [d.table for d in spec.dependencies])
    by = [c.name for c in columns if c.is_partition]
    store = OutcomeStore(spark, lake, as_of, spec)
    temporary = []

    def settled(df: DataFrame, rule_sets: dict[str, Sequence[Rule]]) -> tuple[DataFrame, list[Row]]:
        """The frame as rules, write and ledger read it, and the outcomes of its rules."""
        if not staged:
            return df, outcomes_of_sets(df, rule_sets, approx_rsd).collect()
        # Dealt as it will be written, so that the write needs no shuffle, and measured on the way.
        held, found = staged_outcomes(balanced(df, by), rule_sets, spec.table, approx_rsd)
        temporary.append(held)
        return held.frame, found.collect()

    try:
        if landing:
            # Text files have no columns to prune, so a landing file is parsed once, not once per step.
            source = spec.dependencies[0]
            frame = read_dependency(spark, spec, source, lake, as_of)
            result, found = settled(frame, {READ_PHASE: source.rules, RESULT_PHASE: spec.rules})
            passed = _gate_reads(store, report, policy, [(source, _of_set(found, READ_PHASE))])
            last = _of_set(found, RESULT_PHASE)
        else:
            frames = []
            for dependency in spec.dependencies:
                frames.append(read_dependency(spark, spec, dependency, lake, as_of))
                expose_view(frames[-1], dependency.table)
            found = _input_outcomes(frames, spec.dependencies, approx_rsd)
            passed = _gate_reads(store, report, policy, list(zip(spec.dependencies, found)))
            if passed:
                if sql is None:
                    raise ValueError(f"a {spec.layer} job needs its SQL")
                result = cast_to_columns(run_sql(spark, sql, as_of), columns, keep_nested)
                result, found = settled(result, {RESULT_PHASE: spec.rules})
                last = _of_set(found, RESULT_PHASE)
        if not passed:
            stopped = next(name for name, read in report.reads.items() if read == gates.STOP)
            raise QualityStop(f"{stopped} failed its quality rules", report)

        report.outcomes[f"{RESULT_PHASE}/{spec.table}"] = last
        store.write(RESULT_PHASE, [(spec, last)])
        if gates.goes_on(_passed(last), policy, spec.write_if_fail):
            report.write = gates.WRITE
            write_partitioned(result, report.path, by, as_of, overwrite, balance=not staged)
            record(result, lake.ledger, spec.identifier, by, as_of)
            add_partitions(spark, spec.identifier, result, by)
        for name in outcome_tables:
            if spark.catalog.tableExists(quoted_table(name)):
                store.register(name)
        return report
    finally:
        for one in temporary:
            one.release()
        if not landing:
            for dependency in spec.dependencies:
                drop_view(spark, dependency.table)


@dataclass
class OutcomeStore:
    """Where a job's outcomes go: one write a phase, whatever the number of inputs."""

    spark: SparkSession
    lake: Lake
    as_of: datetime
    job: JobSpec
    written: dict[str, DataFrame] = field(default_factory=dict)

    def write(self, phase: str, found: Sequence[tuple[Dependency | JobSpec, list[Row]]]) -> None:
        rows = None
        for of, outcome_rows in found:
            if not outcome_rows:
                continue
            name = of.identifier if of.database else of.table
            frame = outcome_frame(self.spark, outcome_rows)
            frame = stamp_outcomes(frame, name, self.as_of, self.job.identifier)
            rows = frame if rows is None else rows.unionAll(frame)
        if rows is not None:
            write_outcomes(rows, self.lake.outcomes, phase, self.as_of)
            self.written[phase] = rows

    def register(self, table: str) -> None:
        """Tell the catalog of the partitions that this run wrote to the table's folder."""
        folder = (table_location(self.spark, table) or "").rstrip("/").rpartition("/")[2]
        if folder in self.written:
            add_partitions(self.spark, table, self.written[folder], partition_columns(self.spark, table))
        elif folder not in (READ_PHASE, RESULT_PHASE):
            register_partitions(self.spark, table)


def _input_outcomes(
    frames: Sequence[DataFrame], dependencies: Sequence[Dependency], approx_rsd: float | None
) -> list[list[Row]]:
    """Outcomes of the rules of all inputs: one plan and one collect, so that Spark reads them side by side."""
    union = None
    for i, (frame, dependency) in enumerate(zip(frames, dependencies)):
        if dependency.rules:
            one = outcomes_of_sets(frame, {str(i): dependency.rules}, approx_rsd)
            union = one if union is None else union.unionAll(one)
    rows = union.collect() if union is not None else []
    return [_of_set(rows, str(i)) for i in range(len(frames))]


def _of_set(rows: Sequence[Row], name: str) -> list[Row]:
    return [row for row in rows if row["rule_set"] == name]


def _passed(rows: Sequence[Row]) -> bool:
    return all(row["outcome"] == PASSED for row in rows)


def _gate_reads(
    store: OutcomeStore, report: RunReport, policy: str, found: Sequence[tuple[Dependency, list[Row]]]
) -> bool:
    """Whether the run goes on.  Outcomes are kept up to the first input that stops it, in one write."""
    looked_at = []
    for dependency, rows in found:
        looked_at.append((dependency, rows))
        report.outcomes[f"{READ_PHASE}/{dependency.table}"] = rows
        read = gates.goes_on(_passed(rows), policy, dependency.read_if_fail)
        report.reads[dependency.table] = gates.READ if read else gates.STOP
        if not read:
            break
    store.write(READ_PHASE, looked_at)
    return gates.STOP not in report.reads.values()


def run_sql(spark: SparkSession, sql: str, as_of: datetime | None = None) -> DataFrame:
    """SQL text of a job.  ``:as_of`` in it is the time of the run."""
    if ":as_of" not in sql:
        return spark.sql(sql)
    if as_of is None:
        raise ValueError("the SQL asks for :as_of, but no time was given")
    return spark.sql(sql, args={"as_of": as_of})


def run_table(
    spark: SparkSession, lake: Lake, table: str, as_of: datetime, **options
) -> RunReport:
    """Run the job of a table as its artefacts describe it: its spec and, but for landing jobs, its SQL."""
    spec = load_spec(spark, lake, table)
    sql = None if spec.layer == "CSV" else load_sql(spark, lake, table)
    return run_job(spark, spec, lake, as_of, sql, **options)


def run_merge(
    spark: SparkSession,
    sources: Sequence[str],
    sql: str,
    target: str,
    keys: Sequence[str],
    as_of: datetime | None = None,
    **options,
) -> None:
    """Run SQL over whole catalog tables, each a view under its table name, and append the rows whose
    key the target lacks."""
    names = [source.split(".")[1].lower() for source in sources]
    if len(set(names)) < len(names):
        raise ValueError(f"two sources would share one view name: {sorted(names)}")
    refuse_taken(spark, names)
    try:
        for source in sources:
            expose_view(read_catalog(spark, source), source.split(".")[1])
        merge_insert(spark, run_sql(spark, sql, as_of), target, keys, **options)
    finally:
        for name in names:
            drop_view(spark, name)
