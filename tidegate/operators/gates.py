"""Gates: what a run does with the outcomes of its rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.quality import FAILED, PASSED

# ``strict``: a failed rule always stops a read and always skips a write.
# ``flags``: ReadIfFail and WriteIfFail let a run go on in spite of a failed rule.
POLICIES = ("strict", "flags")

READ, STOP = "read", "stop"
WRITE, SKIP = "write", "skip"


def verdict(outcome_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Outcomes folded to one row (per ``by`` group): number of failed rules, and whether all passed.

    With no outcome rows at all, and no groups, the one row says passed.
    """
    return outcome_rows.groupBy(*by).agg(
        F.count_if(F.col("outcome") == FAILED).alias("failed_rules"),
        F.coalesce(F.bool_and(F.col("outcome") == PASSED), F.lit(True)).alias("passed"),
    )


def goes_on(passed, policy, flag):
    """Whether a gate lets a run go on; for columns as for plain values."""
    return passed | ((policy == "flags") & flag)


def read_action(passed: Column, policy: Column, read_if_fail: Column) -> Column:
    return F.when(goes_on(passed, policy, read_if_fail), READ).otherwise(STOP)


def write_action(passed: Column, policy: Column, write_if_fail: Column) -> Column:
    return F.when(goes_on(passed, policy, write_if_fail), WRITE).otherwise(SKIP)
