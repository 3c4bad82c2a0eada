"""Removal of long byte strings that occur more than once, in the way of merged suffix arrays.

The method merges the Burrows-Wheeler transforms of shards by refining their interleave: suffixes lie in
blocks that share their first bytes, a round makes the shared part longer, blocks of one suffix are done,
and what still shares a block at the wanted depth is a repeat.  Suffixes are never sorted again.  Here the
interleave is kept as block keys (hashes of the shared part) in a table instead of one bit vector, as that
would have to pass through one task, and two things make few rounds and few suffixes of it:

* Only the suffixes at chosen places, anchors, are refined.  Of every ``DEPTH - GRAM + 1`` neighbouring
  strings of ``GRAM`` bytes the one with the smallest hash (the last, if equal) is an anchor.  So each
  window of ``DEPTH`` bytes has one anchor, windows that are equal have theirs at the same place, and an
  anchor has a run of neighbouring windows: its reach, the bytes these cover.
* A round goes from one fixed depth to the next, on both sides of the anchor, not byte by byte.

Round 1: blocks of anchors by their ``GRAM`` bytes.  An anchor alone in its block is done.
Round 2: blocks by whole reach.  Where another anchor has the same reach, all windows of it are repeats:
inside of long common passages every anchor ends here.
Round 3: for blocks of round 1 that hold different reaches, one document of each reach is read again and
its windows, all that share this anchor, are blocks of depth ``DEPTH``; those of two reaches or of two
places in one are repeats.  Only ends of common passages come this far.

The common part of two neighbours is known from the blocks they still share, and the repeated intervals of
a document are the union of its repeated windows.  Every interval of a document goes back to it and is cut.

Texts are UTF-8; NULL is the empty text.  Matches lie in one document; texts under ``DEPTH`` bytes have
none.  Repeated rows are copies of each other.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import free_shuffles, prefix_sums, span_hashes, text_of
from tidegate.storage import stage

DEPTH = 400
GRAM = 200


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values, in a few passes whatever the width."""
    n = len(values) - width + 1
    whole = -(-len(values) // width) * width
    padded = np.full(whole, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(sums: np.ndarray, depth: int = DEPTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of a text given by its prefix sums: each anchor's hash, first window and number of windows."""
    n = len(sums) - 1
    if n < depth:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    width = depth - gram + 1
    starts = np.arange(n - gram + 1)
    hashes = span_hashes(sums, starts, starts + gram)
    least = sliding_minimum(hashes, width)
    new = np.empty(len(least), dtype=bool)
    new[0] = True
    new[1:] = (least[1:] != least[:-1]) | (hashes[width:] == least[1:])
    first = np.flatnonzero(new)
    return least[first], first, np.diff(np.append(first, len(least)))


def remove_repeats(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """A row for each document: its bytes, those removed, the number of removed runs, a digest of the rest."""
    spark = docs.sparkSession
    rows = keyed(docs)
    found = stage(_anchored(rows, depth, gram), "repeats-anchors")
    shared = (
        found.frame.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("n"), F.min("r1").alias("lo"), F.max("r1").alias("hi"))
        .where("n > 1")
        .select("gram", (F.col("lo") < F.col("hi")).alias("differ"))
    )
    held = stage(found.frame.join(shared, "gram"), "repeats-alive")
    alive = held.frame
    found.release()
    free_shuffles(spark)
    reaches = alive.groupBy("gram", "r1", "r2", "differ").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "first", "count")).alias("one")
    )
    blocks = stage(reaches, "repeats-reaches")
    reaches = blocks.frame
    copied = alive.join(reaches.where("n > 1").select("gram", "r1", "r2"), ["gram", "r1", "r2"], "left_semi")
    copied = copied.select(
        "doc", F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + depth).alias("end")
    )
    whole = stage(copied, "repeats-whole")
    held.release()
    readers = reaches.where("differ").select("gram", (F.col("n") == 1).alias("single"), "one.*")
    free_shuffles(spark)
    cut = stage(_windows(rows, readers, depth), "repeats-windows")
    windows = cut.frame
    blocks.release()
    free_shuffles(spark)
    again = windows.groupBy("gram", "w").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    ends = windows.where("single").join(again, ["gram", "w"], "left_semi")
    ends = ends.select("doc", F.col("at").alias("start"), (F.col("at") + depth).alias("end"))
    runs = whole.frame.unionAll(ends).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    runs = stage(runs, "repeats-runs").frame
    cut.release()
    whole.release()
    free_shuffles(spark)
    return _cut(rows, runs)


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with a key made of their id and text.  Equal rows share it, and all that is found of them."""
    text = text_of()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("doc"), text.alias("text")
    )


def _anchored(rows: DataFrame, depth: int, gram: int) -> DataFrame:
    """Anchors of all documents, each with a 128-bit digest of its reach."""

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) < depth:
                    continue
                hashes, first, count = anchors(prefix_sums(np.frombuffer(raw, np.uint8)), depth, gram)
                digests = b"".join(
                    hashlib.blake2b(raw[a : a + n - 1 + depth], digest_size=16).digest()
                    for a, n in zip(first.tolist(), count.tolist())
                )
                pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(first), doc), pa.int64()),
                        pa.array(first, pa.int64()).cast(pa.int32()),
                        pa.array(count, pa.int64()).cast(pa.int32()),
                        pa.array(hashes.view(np.int64), pa.int64()),
                        pa.array(pair[:, 0], pa.int64()),
                        pa.array(pair[:, 1], pa.int64()),
                    ],
                    names=["doc", "first", "count", "gram", "r1", "r2"],
                )

    return rows.select("doc", "text").mapInArrow(
        anchored, "doc long, first int, count int, gram long, r1 long, r2 long"
    )


def _windows(rows: DataFrame, readers: DataFrame, depth: int) -> DataFrame:
    """Every window of the given runs, as a block of the full depth."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs in zip(batch["text"].to_pylist(), batch["runs"].to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                sums = prefix_sums(np.frombuffer(raw, np.uint8))
                first = np.array([r["first"] for r in runs])
                count = np.array([r["count"] for r in runs])
                owner = np.repeat(np.arange(len(runs)), count)
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array([r["doc"] for r in runs])[owner], pa.int64()),
                        pa.array(np.array([r["gram"] for r in runs])[owner], pa.int64()),
                        pa.array(np.array([r["single"] for r in runs])[owner], pa.bool_()),
                        pa.array(at, pa.int64()).cast(pa.int32()),
                        pa.array(span_hashes(sums, at, at + depth).view(np.int64), pa.int64()),
                    ],
                    names=["doc", "gram", "single", "at", "w"],
                )

    # A document's runs are at most its length; equal rows have equal runs, and one of them is read.
    asked = readers.groupBy("doc").agg(F.collect_list(F.struct("doc", "gram", "single", "first", "count")).alias("runs"))
    texts = rows.select("doc", "text").join(asked, "doc").dropDuplicates(["doc"]).select("text", "runs")
    return texts.mapInArrow(cut, "doc long, gram long, single boolean, at int, w long")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _cut(rows: DataFrame, runs: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, numbers, digests = [], [], [], []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                gone = merged([(s["start"], s["end"]) for s in spans or ()])
                kept, at = hashlib.sha256(), 0
                for start, end in gone:
                    kept.update(raw[at:start])
                    at = end
                kept.update(raw[at:])
                sizes.append(len(raw))
                removed.append(sum(e - s for s, e in gone))
                numbers.append(len(gone))
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return (
        rows.join(runs, "doc", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
