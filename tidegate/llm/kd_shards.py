"""Shards of near equal bytes by k-d tree partitioning.  DataFrame operations only.

A node of the tree is a box of the metadata space.  It is split at the weighted median of its widest
dimension (by extent, as a share of the whole table's extent), where a row weighs its bytes, and so on
until the leaves have the target size.  Medians are found by bisection: each round is one aggregation of
bytes into ``BINS`` bins of all open nodes at once, and only those sums reach the driver.

The dimensions are measures of the text, so equal texts lie at one point.  Rows of one value of the split
dimension are told apart by the text's checksum, and a group of equal texts stays in one shard unless it
weighs more than ``GROUP_SHARE`` of one: such a group is cut by ``doc_id``, else a third of all rows could
end in one shard.

NULL texts weigh 1 and have the checksum of the empty text; NULL ids sort first.  With fewer rows than
shards, some shards stay empty.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import if_small, order_bucket, tasks, text_of
from tidegate.storage import stage

BINS = 1024
#: A bin that weighs less than this share of its node is not looked into.
FINE = 1 / 4000
#: A group of equal texts that weighs less than this share of a leaf is not cut.
GROUP_SHARE = 1 / 50


@dataclass
class Node:
    """A box: how many leaves it holds, and once split, where."""

    number: int
    leaves: int
    dim: str | None = None
    #: Rows go left whose (dim, checksum, id) is below this, compared in turn; None ends the comparison.
    cut: tuple = ()
    children: list[Node] = field(default_factory=list)

    def place(self) -> Column:
        """The number of the open node or leaf that a row lies in."""
        if not self.children:
            return F.lit(self.number)
        left, right = self.children
        return F.when(self.goes_left(), left.place()).otherwise(right.place())

    def goes_left(self) -> Column:
        goes = F.lit(False)
        for name, value in reversed(list(zip((self.dim, "_crc", "_id"), self.cut))):
            goes = (F.col(name) < value) | ((F.col(name) == value) & goes)
        return goes


def measured(docs: DataFrame) -> DataFrame:
    """The metadata that rows are placed by."""
    text = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.length(text).cast("long").alias("chars"),
    )


def kd_shards(rows: DataFrame, dims: list[str], shards: int) -> DataFrame:
    """``rows`` with the number of their shard, 0 to ``shards - 1``.

    ``rows`` needs ``doc_id``, ``size``, ``text_crc32`` and whole-number ``dims``.  It is read many times,
    so give it a stored table.
    """
    rows = rows.withColumn("_crc", F.col("text_crc32")).withColumn(
        "_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**62)))
    )
    names = [*dims, "_crc", "_id"]
    ranges = [f(n).alias(f"{k}_{n}") for n in names for k, f in (("lo", F.min), ("hi", F.max))]
    whole = rows.agg(F.sum("size").alias("bytes"), *ranges).first()
    if not whole["bytes"]:
        return rows.select("*", F.lit(0).alias("shard")).drop("_crc", "_id")
    leaf_bytes = whole["bytes"] / shards
    root = Node(0, shards)
    count, open_nodes = 1, [root]
    while open_nodes := [n for n in open_nodes if n.leaves > 1]:
        placed = rows.withColumn("_node", root.place())
        extents = {
            r["_node"]: r for r in placed.groupBy("_node").agg(F.sum("size").alias("bytes"), *ranges).collect()
        }
        searches = []
        for node in open_nodes:
            box = extents.get(node.number)
            if box is None:
                node.leaves = 1
                continue
            node.dim = max(
                dims,
                key=lambda d: (box[f"hi_{d}"] - box[f"lo_{d}"]) / ((whole[f"hi_{d}"] - whole[f"lo_{d}"]) or 1),
            )
            searches.append(_Search(node, box, leaf_bytes))
        _bisect(placed, searches)
        grown = []
        for search in searches:
            node = search.node
            node.cut = search.cut
            node.children = [Node(count, node.leaves // 2), Node(count + 1, node.leaves - node.leaves // 2)]
            count += 2
            grown += node.children
        open_nodes = grown
    leaves = _leaves(root)
    shard = F.lit(0)
    for i, leaf in enumerate(leaves):
        shard = F.when(F.col("_node") == leaf.number, i).otherwise(shard)
    return rows.withColumn("_node", root.place()).withColumn("shard", shard).drop("_node", "_crc", "_id")


def with_slots(rows: DataFrame) -> DataFrame:
    """Gapless numbers from 0 in each shard, by ``doc_id``, without a task that sees a whole shard."""
    rows = rows.withColumn("_part", order_bucket(rows, "doc_id", tasks(rows.sparkSession, 4)))
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col("shard").alias("_s"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"),
    )
    inner = F.row_number().over(
        W.partitionBy("shard", "_part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    )
    return (
        rows.withColumn("_row", inner)
        .join(
            if_small(stage(starts, "slot-starts").frame),
            (F.col("shard") == F.col("_s")) & (F.col("_part") == F.col("_p")),
        )
        .withColumn("slot", (F.col("_start") + F.col("_row") - 1).cast("long"))
        .drop("_part", "_row", "_s", "_p", "_start")
    )


def _leaves(node: Node) -> list[Node]:
    return [x for child in node.children for x in _leaves(child)] if node.children else [node]


class _Search:
    """The bisection of one node: which column it is at, between which values, and what must go left."""

    def __init__(self, node: Node, box, leaf_bytes: float):
        self.node, self.box = node, box
        self.goal = box["bytes"] * (node.leaves // 2) / node.leaves
        self.fine = box["bytes"] * FINE
        self.group = leaf_bytes * GROUP_SHARE
        self.names = (node.dim, "_crc", "_id")
        self.fixed: list[int] = []
        self.cut: tuple | None = None
        self._enter()

    def _enter(self) -> None:
        name = self.names[len(self.fixed)]
        self.lo, self.hi = self.box[f"lo_{name}"], self.box[f"hi_{name}"]

    @property
    def width(self) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // BINS))

    def bin(self) -> Column:
        """The bin of a row that still counts, else NULL."""
        name = self.names[len(self.fixed)]
        here = F.col("_node") == self.node.number
        for other, value in zip(self.names, self.fixed):
            here = here & (F.col(other) == value)
        inside = here & F.col(name).between(self.lo, self.hi)
        return F.when(inside, F.expr(f"(`{name}` - {self.lo}L) div {self.width}L"))

    def step(self, bins: list[tuple[int, int]]) -> None:
        """Narrow down to the bin in which the goal is reached, or cut at one of its edges."""
        before, at, weight = 0, self.hi - self.lo, 0
        for b, w in bins:
            at, weight = b, w
            if before + w >= self.goal:
                break
            before += w
        lo = self.lo + at * self.width
        hi = min(self.hi, lo + self.width - 1)
        edge = lo if self.goal - before <= before + weight - self.goal else hi + 1
        level = len(self.fixed)
        one_value = lo == hi
        if weight <= self.fine or (one_value and (level == 2 or (level == 1 and weight <= self.group))):
            self.cut = (*self.fixed, edge)
            return
        self.goal -= before
        if one_value:
            self.fixed.append(lo)
            self._enter()
        else:
            self.lo, self.hi = lo, hi


def _bisect(placed: DataFrame, searches: list[_Search]) -> None:
    while going := [s for s in searches if s.cut is None]:
        found = F.coalesce(*[s.bin() for s in going])
        sums = (
            placed.select("_node", "size", found.alias("bin"))
            .where(F.col("bin").isNotNull())
            .groupBy("_node", "bin")
            .agg(F.sum("size").alias("w"))
            .collect()
        )
        for search in going:
            search.step(sorted((r["bin"], r["w"]) for r in sums if r["_node"] == search.node.number))
