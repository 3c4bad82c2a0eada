"""Mixing sources to target weights by capped water-filling.

Every source asks for a share of the mix by its weight, but may be repeated ``max_epochs`` times at most.
What a capped source cannot give is shared again among the rest by weight, until none is above its cap.
The level that this process ends at is found in one sorted pass over the sources: with sources in order of
``cap / weight``, those before some point are capped, and the first one that is not gives the level.

Documents are then repeated: the whole part of ``target / size`` for each document of the source, and once
more for those whose seeded hash lies under a threshold.  The threshold is the weighted quantile of the
hashes at which the sizes add up to the rest of the target, so a source's words come within one document
of its target.  It is found from a histogram of hashes and an exact look into one bin, so no task sees
all rows of a source, and with the thresholds known, each document is decided where it is read.

NULL sources are one source, the last.  A text that is NULL, empty or blank has size 0: it follows its
source's repetitions but adds no words.  Rows that share a ``doc_id`` share their hash, so they are taken
or left together.  An empty table gives an empty mix.  Columns of the input keep their names and values,
but for those named in ``ADDED``, which the operator's replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import if_small, text_of
from tidegate.storage import stage

WORD = r"[^\x20\x09-\x0D]+"
BIN_BITS = 12
ADDED = ("size", "source_size", "target", "copies", "taken")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 20240201,
) -> DataFrame:
    """``docs`` with their size in words, the target of their source, how often the mix takes them
    (``copies``) and the words it takes (``taken``)."""
    spark = docs.sparkSession
    base = docs.drop(*ADDED)
    # The input in one column, so that no name clashes.
    sized = base.select(
        F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("doc"),
        F.col("source").alias("own_source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        _draw(seed).alias("draw"),
    )
    rows = stage(sized.select(F.col("own_source").alias("source"), "size", "draw"), "mix-sizes").frame
    plan = stage(_thresholds(rows, source_targets(rows, weights, share, max_epochs)), "mix-plan").frame
    joined = sized.join(if_small(plan.drop("size")), F.col("own_source").eqNullSafe(F.col("source")), "left")
    copies = (F.col("whole") + F.when(F.col("draw") <= F.col("upto"), 1).otherwise(0)).cast("int")
    made = joined.withColumn("copies", copies).withColumn("taken", (F.col("size") * F.col("copies")).cast("long"))
    return made.select(*[f"doc.`{c}`" for c in base.columns], *ADDED)


def repeated(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, without the columns that ``mix`` added."""
    kept = [c for c in mixed.columns if c not in ADDED]
    doc = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    rows = mixed.where("copies > 0").select(doc, F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    return rows.select("doc.*")


def source_targets(
    rows: DataFrame, weights: Sequence[float], share: float, max_epochs: float
) -> DataFrame:
    """A row for each source: its size and its target, from rows of (source, size)."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    sources = sources.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * F.lit(float(max_epochs))
    )
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    weight_left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    ratio = F.col("cap") / F.col("weight")
    sources = sources.withColumn("level", left / weight_left).withColumn("nth", F.row_number().over(by_ratio))
    # Levels behind the first uncapped source have caps taken off that are not reached, so among sources of
    # one ratio the first of the order counts, not the lowest level.
    level = F.min(F.when(F.col("level") < ratio, F.struct("nth", "level"))).over(everything)
    fill = level.getField("level")
    return sources.withColumn("fill", fill).select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("fill") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def _draw(seed: int) -> Column:
    """A seeded number from 0 to 2**53 - 1 for each document."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11)


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Whole repetitions of each source, and the draw up to which its documents come once more."""
    width = 1 << (53 - BIN_BITS)
    targets = targets.withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    binned = rows.withColumn("bin", F.floor(F.col("draw") / width))
    filled = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    upto_bin = F.sum("words").over(W.partitionBy("source").orderBy("bin"))
    filled = filled.withColumn("upto_bin", upto_bin)
    goal = targets.select(F.col("source").alias("s"), "rest")
    edge = (
        filled.join(if_small(goal), F.col("source").eqNullSafe(F.col("s")))
        .where("upto_bin >= rest AND rest > 0")
        .groupBy("source")
        .agg(F.min(F.struct("bin", (F.col("rest") - F.col("upto_bin") + F.col("words")).alias("need"))).alias("e"))
        .select(F.col("source").alias("s"), F.col("e.bin").alias("edge_bin"), F.col("e.need").alias("need"))
    )
    edge = stage(edge, "mix-edges").frame
    inside = binned.join(
        if_small(edge), F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("edge_bin"))
    )
    running = F.sum("size").over(
        W.partitionBy("source").orderBy("draw", "size").rowsBetween(W.unboundedPreceding, 0)
    )
    last = (
        inside.withColumn("running", running - F.col("size") / 2)
        .where("running <= need")
        .groupBy("source")
        .agg(F.max("draw").alias("last"))
        .select(F.col("source").alias("s2"), "last")
    )
    return (
        targets.join(if_small(edge), F.col("source").eqNullSafe(F.col("s")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("s2")), "left")
        .select(
            "source",
            "source_size",
            "target",
            "whole",
            F.coalesce("last", F.col("edge_bin") * width - 1, F.lit(-1)).cast("long").alias("upto"),
        )
    )
