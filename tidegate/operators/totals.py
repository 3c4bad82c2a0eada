"""Grouped sums and tagged unions.

Both group with a map-side partial sum, so a hot key costs one partial row per task, and a total does
not depend on how the rows were split: amounts are summed as decimals, not as floating point numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.casts import lenient_cast

# Fixed value: the type amounts are summed in.
AMOUNT_TYPE = "decimal(38,10)"


def totals(
    df: DataFrame, keys: Sequence[str | Column], amount: str, name: str, exact: bool = True
) -> DataFrame:
    """Sum of ``amount`` by ``keys``, each a column name or an aliased expression.

    ``exact`` takes numbers or texts as ``decimal(38,10)``; a text that is no number counts as NULL.
    """
    value = F.col(amount)
    if exact:
        value = lenient_cast(value, df.schema[amount].dataType, AMOUNT_TYPE)
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def union_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct rows of all frames: columns match by position, names come from the first frame."""
    for other in others:
        first = first.union(other)
    return first.distinct()


@dataclass(frozen=True)
class Branch:
    """One source of a tagged union.  ``day`` is an expression to group by, or text for a fixed day."""

    frame: DataFrame
    tag: str
    key: str
    customer: str
    amount: str
    day: Column | str


def tagged_totals(branches: Sequence[Branch]) -> DataFrame:
    """Exact totals by key, customer and day of several sources, each row tagged with its source.

    The meaning is the distinct union of the branches.  Distinct tags keep the branches apart, and
    within a branch every row is one group, so the rows are distinct already and the shuffle of a
    ``distinct()`` is saved.  It is only run if a key type is one where two values can share a text.
    """
    tags = [b.tag for b in branches]
    if len(set(tags)) < len(tags):
        raise ValueError(f"every branch needs a tag of its own: {tags}")
    result = _branch_totals(branches[0])
    for branch in branches[1:]:
        result = result.unionAll(_branch_totals(branch))
    if all(_one_text_per_value(b.frame, c) for b in branches for c in (b.key, b.customer)):
        return result
    return result.distinct()


def _branch_totals(branch: Branch) -> DataFrame:
    grouped_day = not isinstance(branch.day, str)
    keys = [F.col(branch.key), F.col(branch.customer)]
    if grouped_day:
        keys.append(branch.day.alias("_day"))
    grouped = totals(branch.frame, keys, branch.amount, "_total")
    return grouped.select(
        F.col(branch.key).cast("string").alias("contract_id"),
        F.col(branch.customer).cast("string").alias("customer_id"),
        F.col("_total").alias("valor"),
        F.lit(branch.tag).alias("fonte"),
        (F.col("_day") if grouped_day else F.lit(branch.day)).alias("data_processamento"),
    )


def _one_text_per_value(df: DataFrame, column: str) -> bool:
    return isinstance(
        df.select(column).schema[0].dataType,
        (T.IntegralType, T.StringType, T.DecimalType, T.DateType, T.BooleanType),
    )
