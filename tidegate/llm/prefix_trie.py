"""Prefix trie of turn sequences, built by halving depths (van Emde Boas recursion).

A block is a range of ``2**s`` depths.  What lies in it is a forest: a tree for each node just above it.  It
is cut at half its depth.  The cut prefixes are named, the upper half becomes a trie over the distinct
prefixes, and each name becomes the root of a tree in the lower half.  All blocks of one size are cut in one
round, so ``log2`` of the longest sequence rounds are enough, both for the way down and for the totals.

1. Names.  Turns are hashed (128 bits of SHA-256 over role and text) before anything is shuffled.  Blocks are
   named from the names of their halves, so a long sequence is spread over tasks by (conversation, block).
   Equal sequences fold into one item, with the number of conversations and the smallest of them.
2. Down.  An item is a path through one tree of a block.  Its smallest conversation looks up the names of its
   halves, by a key that is unique on both sides.  Items that agree in the upper half fold into one upper item;
   the smallest conversation of that item names the prefix, and is the tree of the lower items.
   After the last round an item is a node: (smallest conversation, depth) identifies it.
3. Up.  Totals of each tree within its block: those of the upper half and of the lower trees at its leaves.
4. Graft.  The total of a lower tree is handed to the path above it, halved like the items were, and added to
   each node of the path.

Prefixes that many items share are joined apart: those with over a thousandth of all items, so at most a
thousand rows, are broadcast.  Nothing is collected but counts, and each round is a table in the shared folder.

Turns are ordered by ``turn``, NULL first, and where numbers tie by their hash.  NULL role or text is the empty
string.  Rows without ``conv_id`` are no conversation and are left out; repeated rows are repeated turns.
Texts of any length are only hashed.  An empty table has no nodes, not even a root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import join_hot, tasks, text_of
from tidegate.storage import Staged, stage

#: So many turns of one conversation share a join key.
TURNS_A_KEY = 4096
#: Lists of ids are put together in pieces of so many ids.
IDS_A_PIECE = 4096


@dataclass(frozen=True)
class Trie:
    """``nodes``, one row each, and ``ends``: (end, conv_id) for each conversation, at the node with that ``end``."""

    nodes: DataFrame
    ends: DataFrame


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, token) of all turns: ``pos`` from 0 in each conversation, ``token`` equal for equal turns.

    One sort by range, so a conversation with most of the turns is spread over tasks; turns before those of a
    task are added from counts, of which there is at most one a task.
    """
    role, text = text_of("role"), text_of("text")
    name = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    slim = stage(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").alias("turn"),
            F.concat(name, F.lit(":"), F.octet_length(text).cast("string")).alias("token"),
        ),
        "trie-turns",
    )
    order = ["conv_id", "turn", "token"]
    ranged = slim.frame.repartitionByRange(tasks(conversations.sparkSession), *order).sortWithinPartitions(*order)
    counted = stage(
        ranged.select("conv_id", "token").mapInArrow(_count_runs, "conv_id long, task int, at long, token string"),
        "trie-numbered",
    )
    slim.release()
    shares = counted.frame.groupBy("conv_id", "task").agg(F.count(F.lit(1)).alias("n"))
    spanning = shares.groupBy("conv_id").agg(F.collect_list(F.struct("task", "n")).alias("parts")).where(
        F.size("parts") > 1
    )
    before = F.aggregate(
        F.filter("parts", lambda p: p["task"] < F.col("part.task")), F.lit(0).cast("long"), lambda a, p: a + p["n"]
    )
    spanning = spanning.select("conv_id", "parts", F.explode("parts").alias("part"))
    offsets = spanning.select("conv_id", F.col("part.task").alias("task"), before.alias("before")).where("before > 0")
    # At most a row a task; kept, as the numbered turns are read more than once.
    offsets = stage(offsets.coalesce(1), "trie-offsets").frame
    return counted.frame.join(F.broadcast(offsets), ["conv_id", "task"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "token"
    )


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers rows within their conversation; rows come sorted."""
    task, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch["conv_id"].to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        first = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
        lengths = np.diff(np.concatenate([first, [len(ids)]]))
        at = np.arange(len(ids)) - np.repeat(first, lengths)
        if ids[0] == last:
            at[: lengths[0]] += held
        last, held = ids[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], pa.array(np.full(len(ids), task, np.int32)), pa.array(at), batch["token"]],
            names=["conv_id", "task", "at", "token"],
        )


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Sequences, and their lengths, in which conversations of a group start alike.

    Of conversation ``c``, the first ``crc32(c) % heads`` turns are those of ``c - c % group`` (as many as it
    has; none if it is not there).  Conversations that are left without turns have the length 0.
    """
    # The remainder takes the sign of the id, as in SQL.
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    own = counts.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head.alias("h"))
    found = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = stage(
        own.join(found, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "trie-plan"
    ).frame
    firsts = (
        turns.where(F.col("pos") < heads - 1)
        .withColumnRenamed("conv_id", "base")
        .join(plan.select("conv_id", "base", "h"), "base")
        .where("pos < h")
        .select("conv_id", "pos", "token")
    )
    part = F.floor(F.col("pos") / TURNS_A_KEY)
    moves = plan.where("n > h").select(
        "conv_id", "h", "taken", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / TURNS_A_KEY))).alias("part")
    )
    rest = (
        turns.where(F.col("pos") >= head)
        .withColumn("part", part)
        .join(moves, ["conv_id", "part"])
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "token")
    )
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return firsts.unionAll(rest), lengths


def prefix_trie(sequences: DataFrame, lengths: DataFrame) -> Trie:
    """The trie over sequences (conv_id, pos, token) of the conversations in ``lengths`` (conv_id, n).

    A token ends in ``:`` and the bytes of its text.  Nodes have ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``token`` of their last turn
    and ``end``, which leads to the conversations that end there (NULL: none).
    """
    spark = sequences.sparkSession
    root = lengths.agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("id"), F.max("n").alias("longest"),
        F.count_if(F.col("n") == 0).alias("blank"),
    ).first()
    blank_ends = lengths.where("n = 0").select(F.lit("").alias("end"), "conv_id")
    if not root["longest"]:
        alone = _root_row(spark, root, 0, (1, 0)) if root["n"] else _no_nodes(spark)
        return Trie(alone, blank_ends)
    rounds = (root["longest"] - 1).bit_length()
    names = sequences.select("conv_id", F.col("pos").cast("long").alias("block"), F.col("token").alias("name"))
    if not rounds:
        names = stage(names, "trie-names").frame
    halves: list[Staged] = []
    for _ in range(rounds):
        halves.append(stage(_halves(names), "trie-halves"))
        names = halves[-1].frame.select("conv_id", "block", "name")

    top = names.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    items = stage(
        top.select(F.lit(0).cast("long").alias("block"), F.lit(root["id"]).alias("tree"), "name", "n", "least", F.col("name").alias("end")),
        "trie-items",
    )
    cuts: list[Cut] = []
    for level in reversed(range(rounds)):
        cut, below = _cut(items.frame, halves[level].frame)
        items.release()
        cuts.insert(0, cut)
        items = below
    nodes = stage(_with_values(items.frame), "trie-nodes").frame
    items.release()
    totals = [stage(nodes.groupBy("block", "tree").agg(*_sums("leaf", "saved")), "trie-totals")]
    for cut in cuts:
        totals.append(stage(_tree_totals(totals[-1].frame, cut.upper), "trie-totals"))
    grafts = None
    for level in reversed(range(rounds)):
        above, grafts = grafts, stage(_grafts(grafts, cuts[level].paths, totals[level].frame), "trie-grafts")
        if above:
            above.release()
    if grafts:
        added = grafts.frame.select("block", "least", F.col("leaf").alias("more_leaf"), F.col("saved").alias("more_saved"))
        nodes = nodes.join(added, ["block", "least"], "left")
    else:
        nodes = nodes.withColumn("more_leaf", F.lit(0)).withColumn("more_saved", F.lit(0))
    whole = totals[-1].frame.select("leaf", "saved").first()
    children = nodes.where("block = 0").count()
    below_root = nodes.select(
        F.col("least").alias("conv_id"),
        (F.col("block") + 1).alias("depth"),
        F.col("tree").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        F.col("name").alias("token"),
        "end",
    )
    ends = names.select(F.col("name").alias("end"), "conv_id").unionAll(blank_ends)
    return Trie(below_root.unionByName(_root_row(spark, root, children, whole)), ends)


@dataclass(frozen=True)
class Cut:
    """One round: upper items (block, tree, upper), and the upper item of each path (block, least, upper, lower)."""

    upper: DataFrame
    paths: DataFrame


def _halves(names: DataFrame) -> DataFrame:
    """Blocks of twice the size, with the names of their halves."""
    odd = F.col("block") % 2 == 1
    return (
        names.groupBy("conv_id", F.shiftright("block", 1).alias("pair"))
        .agg(F.max(F.when(~odd, F.col("name"))).alias("first"), F.max(F.when(odd, F.col("name"))).alias("second"))
        .select(
            "conv_id", F.col("pair").alias("block"), "first", "second",
            F.substring(F.sha2(F.concat_ws("|", "first", "second"), 256), 1, 32).alias("name"),
        )
    )


def _cut(items: DataFrame, halves: DataFrame) -> tuple[Cut, Staged]:
    """Cuts all blocks at half depth: the round's links, and the items of both halves."""
    looked_up = halves.select(F.col("conv_id").alias("least"), "block", "first", "second")
    both = stage(items.drop("name").join(looked_up, ["least", "block"]), "trie-both")
    upper = stage(
        both.frame.groupBy("block", "tree", "first").agg(
            F.sum("n").alias("n"),
            F.min("least").alias("upper"),
            F.max(F.when(F.col("second").isNull(), F.col("end"))).alias("end"),
            F.count(F.lit(1)).alias("times"),
        ),
        "trie-upper",
    )
    keys = ["block", "tree", "first"]
    paths = stage(
        join_hot(both.frame.select(*keys, "least", "second", "n", "end"), upper.frame.select(*keys, "upper", "times"), keys),
        "trie-paths",
    )
    both.release()
    above = upper.frame.select(
        (F.col("block") * 2).alias("block"), "tree", F.col("first").alias("name"), "n", F.col("upper").alias("least"), "end"
    )
    below = paths.frame.where("second IS NOT NULL").select(
        (F.col("block") * 2 + 1).alias("block"), F.col("upper").alias("tree"), F.col("second").alias("name"), "n", "least", "end"
    )
    links = paths.frame.select("block", "least", "upper", F.col("second").isNotNull().alias("lower"))
    return Cut(upper.frame.select("block", "tree", "upper"), links), stage(above.unionAll(below), "trie-items")


def _with_values(items: DataFrame) -> DataFrame:
    """Nodes with what they add to the totals of the trees above them."""
    children = items.groupBy(F.col("block").alias("below"), F.col("tree").alias("least")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    children = children.select((F.col("below") - 1).alias("block"), "least", "n_children")
    size = F.substring_index("name", ":", -1).cast("long")
    return items.join(children, ["block", "least"], "left").select(
        "block", "tree", "least", "n", "name", "end",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaf"),
        ((F.col("n") - 1) * size).alias("saved"),
    )


def _sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _tree_totals(totals: DataFrame, upper: DataFrame) -> DataFrame:
    """Totals of trees in blocks of twice the size: their own in the upper half, and those of the trees below."""
    own = totals.where("block % 2 = 0").select(F.shiftright("block", 1).alias("block"), "tree", "leaf", "saved")
    lower = totals.where("block % 2 = 1").select(
        F.shiftright("block", 1).alias("block"), F.col("tree").alias("upper"), "leaf", "saved"
    )
    lower = lower.join(upper, ["block", "upper"]).select("block", "tree", "leaf", "saved")
    return own.unionAll(lower).groupBy("block", "tree").agg(*_sums("leaf", "saved"))


def _grafts(above: Staged | None, paths: DataFrame, totals: DataFrame) -> DataFrame:
    """What each path of the halves has to add to its nodes: from later blocks, and from the trees at its end."""
    ends = totals.where("block % 2 = 1").select(
        (F.col("block") - 1).alias("block"), F.col("tree").alias("least"), "leaf", "saved"
    )
    if above is None:
        return ends
    held = paths.join(above.frame, ["block", "least"])
    upper = held.select((F.col("block") * 2).alias("block"), F.col("upper").alias("least"), "leaf", "saved")
    lower = held.where("lower").select((F.col("block") * 2 + 1).alias("block"), "least", "leaf", "saved")
    return ends.unionAll(upper).unionAll(lower).groupBy("block", "least").agg(*_sums("leaf", "saved"))


_NODE = {
    "conv_id": "long", "depth": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long",
    "n_leaves": "long", "saved_tokens": "long", "token": "string", "end": "string",
}


def _root_row(spark, root, children: int, whole) -> DataFrame:
    values = [root["id"], 0, None, root["n"], children, whole[0], whole[1], None, "" if root["blank"] else None]
    return spark.range(1).select([F.lit(v).cast(t).alias(c) for v, (c, t) in zip(values, _NODE.items())])


def _no_nodes(spark) -> DataFrame:
    return spark.range(0).select([F.lit(None).cast(t).alias(c) for c, t in _NODE.items()])


def id_lists_sha256(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, sha256): the hash of each key's values, ascending, in decimal, joined by commas.

    Values are sorted by range over (key, value), so a key with most of them is spread over tasks, and put in
    pieces.  A hash has to read its input in order: one task reads a key's pieces, as a stream.
    """
    order = ["key", "value"]
    ranged = (
        rows.select(F.col(key).alias("key"), F.col(value).cast("long").alias("value"))
        .repartitionByRange(tasks(rows.sparkSession), *order)
        .sortWithinPartitions(*order)
    )
    pieces = ranged.mapInArrow(_pieces, "key string, value long, piece string")
    return (
        pieces.repartition("key")
        .sortWithinPartitions(*order)
        .mapInArrow(_hashed, "key string, sha256 string")
        .withColumnRenamed("key", key)
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        key, ids = None, []
        for k, v in zip(batch["key"].to_pylist(), batch["value"].to_pylist()):
            if ids and (k != key or len(ids) == IDS_A_PIECE):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(v)
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
        yield _batch(out, ["key", "value", "piece"], [pa.string(), pa.int64(), pa.string()])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    for batch in batches:
        out = []
        for k, piece in zip(batch["key"].to_pylist(), batch["piece"].to_pylist()):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(piece.encode())
        yield _batch(out, ["key", "sha256"], [pa.string(), pa.string()])
    if state is not None:
        yield _batch([(key, state.hexdigest())], ["key", "sha256"], [pa.string(), pa.string()])


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)
