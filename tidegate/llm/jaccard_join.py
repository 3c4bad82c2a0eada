"""Jaccard similarity join of word shingle sets by PartEnum signatures, and the groups it links.

Sets of one size band, or of neighbouring bands, that reach the similarity differ in at most ``k`` shingles
(``k`` follows from the band).  The domain of shingles is cut, by hash, into ``n1`` parts, each part into
``SECOND`` pieces.  Of ``n1`` parts, two such sets have at least ``n1 - k // 2`` in which they differ in at
most one shingle, and there all pieces but one are equal.  So a signature is what a set has in all pieces
of one part but one, and a set has ``SECOND`` signatures a part, for its own band and the next.

Signatures of nothing say nothing, so they are left out.  That loses no pair: a part in which a set has
such a signature is called bare; if a set has fewer bare parts than the parts that must agree, one of
these is not bare.  Sets with more bare parts (small ones) also have their ``n - ceil(0.8 n) + 1`` smallest
hashes as signatures: a pair that could be missed is of two such sets, and shares one of these.

1. Sets are folded if equal: every later step works on one class for each set, so a large group of copies
   is one row.  Sets of under 4 shingles are done: unequal ones cannot reach the similarity.
2. Of its ``n - ceil(0.8 n) + ceil(n / 10)`` smallest shingle hashes a set shares at least ``0.08 n`` with a
   similar one, which has them among its smallest too.  Sets that share fewer with any others are done.
3. The others are made whole.  Shingles that none of the others has bound the size of a similar set; sets that
   no size fits are done.  What is left gets signatures.  Buckets of equal members are one bucket.
4. In a bucket, every member meets the pivot, the member that meets most others.  Pairs whose sizes or
   parities (1024 bits of the set) are too far apart are dropped, the rest is compared.  Members that follow
   the same pivots are of one group.
5. In buckets that are not yet one group, the members outside the group of the pivot meet those of other
   groups, under the same bounds, and these pairs are compared as well.  A bucket in one group is settled: its
   members are connected, whatever its size.
6. Groups are the connected components of all links.

Comparison is on whole sets of 64-bit shingle hashes: intersection and union sizes, without rounding.

A text without words (NULL, empty, blank) has an empty set, which is linked with nothing; a text of fewer
than five words has its whole word sequence as the only shingle.  Rows with one ``doc_id`` are one document
with several sets: they share a component.  Rows whose ``doc_id`` is NULL have the component NULL and link
nothing.  An empty table gives no rows.  Other columns are not read, and kept by ``first_of_each`` whatever their
names.  Texts of any length are read whole, in memory in proportion to their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import free_shuffles, join_hot, mixed, prefix_sums, span_hashes, text_of
from tidegate.llm.components import components
from tidegate.llm.minhash import _can_link, _confirmed, _followed, _linkable, _side, parities
from tidegate.storage import Staged, stage

SHINGLE = 5
#: Similarity as a fraction of whole numbers, so that no rounding decides.
PERCENT = 80
SECOND = 3
#: Unequal sets of fewer shingles differ too much.
LEAST_SIZE = 4


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; words are cut at ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    data = np.frombuffer(line, np.uint8)
    spaces = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(data)]])
    n = max(1, len(words) - SHINGLE + 1)
    last = min(SHINGLE, len(words)) - 1
    return np.unique(span_hashes(prefix_sums(data), starts[:n], ends[last : last + n]))


def band_edges(n: int) -> list[tuple[int, int]]:
    """Size bands up to the one of ``n``: the ends of a band are as far apart as similar sets can be."""
    bands, low = [], 1
    while not bands or bands[-1][1] < n:
        bands.append((low, low * 100 // PERCENT))
        low = bands[-1][1] + 1
    return bands


def largest_difference(size_sum: int) -> int:
    """How many shingles two similar sets with this sum of sizes can have apart."""
    return size_sum * (100 - PERCENT) // (100 + PERCENT)


def spare_parts(k: int) -> int:
    """How many parts must agree: more than one, so that few sets keep their signatures of nothing."""
    return 3 + k // 8


def signatures(sets: np.ndarray) -> np.ndarray:
    """The signatures of a sorted set of hashes, for its own size band and the next."""
    n = len(sets)
    bands = band_edges(n)
    own = len(bands) - 1
    high = [bands[own][1], (bands[own][1] + 1) * 100 // PERCENT]
    weights = mixed(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    places = mixed(sets + np.uint64(0x5BD1E9955BD1E995))
    out = []
    for band, top in zip((own, own + 1), high):
        k = largest_difference(2 * top)
        must = spare_parts(k)
        n1 = k // 2 + must
        piece = (places % np.uint64(n1 * SECOND)).astype(np.int64)
        sums = np.zeros(n1 * SECOND, dtype=np.uint64)
        np.add.at(sums, piece, weights)
        count = np.bincount(piece, minlength=n1 * SECOND).reshape(n1, SECOND)
        sums = sums.reshape(n1, SECOND)
        without = sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums
        filled = count.sum(axis=1, keepdims=True) - count > 0
        if (~filled.all(axis=1)).sum() >= must:
            least = sets[: n - -(-n * PERCENT // 100) + 1]
            out.append(mixed(least ^ mixed(np.array([~band], dtype=np.int64).view(np.uint64))))
        number = np.arange(n1 * SECOND, dtype=np.uint64).reshape(n1, SECOND)
        salt = mixed(number + np.uint64(band << 32))
        out.append(mixed(without ^ salt)[filled])
    return np.concatenate(out).view(np.int64)


def join_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, the size of its set and its component for every row."""
    spark = docs.sparkSession
    sized = stage(_sized(docs), "jaccard-sized")
    # The smallest hashes weigh the most; what is read later is kept without them.
    numbered = stage(sized.frame.drop("least"), "jaccard-rows")
    rows = numbered.frame
    known = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = (
        known.groupBy("f1", "f2")
        .agg(F.min(F.struct("doc_id", "key", "n")).alias("m"), F.count(F.lit(1)).alias("times"))
        .select(F.monotonically_increasing_id().alias("cid"), "f1", "f2", "m.doc_id", "m.key", "m.n", "times")
    )
    classes = stage(classes, "jaccard-classes")
    chosen = classes.frame.where(F.col("n") >= LEAST_SIZE).select("cid", "doc_id", "key")
    least = sized.frame.join(chosen.hint("merge"), ["doc_id", "key"]).select("cid", "least")
    least = stage(least, "jaccard-least")
    sized.release()
    free_shuffles(spark)
    seeds = _sharing(least.frame, classes.frame)
    least.release()
    free_shuffles(spark)
    sets = stage(_sets(docs, seeds.frame), "jaccard-sets")
    seeds.release()
    free_shuffles(spark)
    links = _links(sets.frame)
    sets.release()
    free_shuffles(spark)
    numbers = classes.frame.select("cid", "doc_id")
    linked = (
        links.frame.join(numbers.toDF("a", "one"), "a").join(numbers.toDF("b", "two"), "b")
    ).select(F.col("one").alias("a"), F.col("two").alias("b"))
    first = classes.frame.select("f1", "f2", F.col("doc_id").alias("rep"), "times")
    copies = (
        join_hot(known.select("doc_id", "f1", "f2"), first, ["f1", "f2"])
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    found = components(linked.unionAll(copies)).groupBy("node").agg(F.min("component").alias("component"))
    named = rows.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
    named = stage(named, "jaccard-named").frame
    for done in (numbered, classes, links):
        done.release()
    return named


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest ``doc_id``, columns as they were."""
    found = join_classes(docs.select("doc_id", "text"))
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("dropped")).distinct()
    dropped = stage(dropped, "jaccard-dropped").frame
    # The input in one column, so that no name clashes.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").alias("id"))
    return rows.join(dropped, F.col("id") == F.col("dropped"), "left_anti").select("doc.*")


def _sized(docs: DataFrame) -> DataFrame:
    """For each document: the size of its set, a 128-bit digest of it and its smallest hashes."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, ones, twos, least = [], [], [], []
            for text in batch["text"].to_pylist():
                found = shingles(text)
                n = len(found)
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                ns.append(n)
                ones.append(int(digest[0]))
                twos.append(int(digest[1]))
                least.append(found[: n - -(-n * PERCENT // 100) + -(-n // 10)].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["key"],
                    pa.array(ns, pa.int64()),
                    pa.array(ones, pa.int64()),
                    pa.array(twos, pa.int64()),
                    pa.array(least, pa.list_(pa.int64())),
                ],
                names=["doc_id", "key", "n", "f1", "f2", "least"],
            )

    return _keyed(docs).mapInArrow(sized, "doc_id long, key long, n long, f1 long, f2 long, least array<bigint>")


def _sharing(least: DataFrame, classes: DataFrame) -> Staged:
    """Classes that share enough of their smallest hashes with other classes."""
    spread = least.select("cid", F.explode("least").alias("h"))
    # The hashes of a class are distinct, so a count tells whether another class has one (rows that are repeated
    # with their id count again, which only keeps more).
    shared = stage(spread.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h"), "jaccard-shared")
    free_shuffles(least.sparkSession)
    found = spread.join(shared.frame, "h", "left_semi").groupBy("cid").agg(F.count(F.lit(1)).alias("shares"))
    enough = F.col("shares") * 100 >= F.col("n") * (PERCENT // 10)
    seeds = stage(found.join(classes.select("cid", "key", "n"), "cid").where(enough).select("cid", "key"), "jaccard-seeds")
    shared.release()
    return seeds


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key, so that a document can be found again where a ``doc_id`` has several texts."""
    text = text_of()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("key"), text.alias("text")
    )


def _sets(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Whole sets, signatures and parities of the classes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["cid"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([signatures(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["cid", "n", "hashes", "signatures", "bits"],
            )

    # Equal rows share a key; one of them is read.  The join has dealt the rows by key already; it is one at every size.
    texts = _keyed(docs).select("key", "text").join(seeds.hint("merge"), "key").dropDuplicates(["key"]).select("cid", "text")
    return texts.mapInArrow(
        made, "cid long, n long, hashes array<bigint>, signatures array<bigint>, bits array<bigint>"
    )


def _bucket_members(spread: DataFrame) -> Staged:
    """(s, cid, times) of every set in every bucket that holds others; of buckets of equal members, one is kept."""
    sizes = spread.groupBy("s").agg(
        F.count(F.lit(1)).alias("times"),
        F.bit_xor(F.xxhash64("cid")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("y"),
    )
    kept = sizes.where("times > 1").groupBy("times", "x", "y").agg(F.min("s").alias("s"))
    kept = stage(kept.select("s", "times", F.col("times").alias("size")), "jaccard-buckets")
    members = join_hot(spread, kept.frame, ["s"]).select("s", "cid", F.col("size").alias("times"))
    members = stage(members, "jaccard-members")
    kept.release()
    return members


def _links(sets: DataFrame) -> Staged:
    """Links (a, b) that connect exactly what the links between all similar sets connect."""
    able = stage(_linkable(sets, sets.select("cid", F.lit(0).alias("score"))).drop("score"), "jaccard-able")
    spread = sets.join(able.frame.select("cid"), "cid", "left_semi").select("cid", F.explode("signatures").alias("s"))
    held = _bucket_members(spread)
    members = held.frame
    scores = stage(members.groupBy("cid").agg(F.sum("times").alias("score")), "jaccard-scores")
    pivots = (
        members.join(scores.frame, "cid")
        .groupBy("s")
        .agg(F.max(F.struct("score", "cid")).alias("p"), F.count(F.lit(1)).alias("times"))
        .select("s", F.col("p.cid").alias("p"), "times")
    )
    pivots = stage(pivots, "jaccard-pivots")
    met = join_hot(members.select("s", "cid"), pivots.frame, ["s"]).where("cid <> p")
    pairs = met.select(F.col("cid").alias("a"), F.col("p").alias("b")).distinct()
    tried = stage(_near(pairs, able.frame), "jaccard-tried")
    first = stage(_confirmed(tried.frame, sets), "jaccard-first")
    groups = stage(_followed(first.frame, scores.frame), "jaccard-groups")

    labelled = members.select("s", "cid").join(groups.frame, "cid", "left").select(
        "s", "cid", F.coalesce("g", "cid").alias("g")
    )
    of_pivot = pivots.frame.join(groups.frame, F.col("p") == F.col("cid"), "left").select(
        "s", "times", F.coalesce("g", "p").alias("pg")
    )
    sided = stage(join_hot(labelled, stage(of_pivot, "jaccard-sides").frame, ["s"]), "jaccard-labelled")
    outside = stage(sided.frame.where("g <> pg").select("s", "cid", "g"), "jaccard-outside")
    # Members of the pivot's group meet only those outside; two outside meet once.
    opened = stage(outside.frame.groupBy("s").agg(F.count(F.lit(1)).alias("times")), "jaccard-open")
    inside = join_hot(sided.frame.where("g = pg").select("s", "cid", "g"), opened.frame, ["s"])
    bounds = able.frame.select("cid", F.struct("cid", "n", "most", "bits").alias("m"))
    x = outside.frame.join(bounds, "cid").select("s", F.col("g").alias("xg"), *_side("x", "m"))
    others = inside.withColumn("own", F.lit(True)).unionByName(outside.frame.withColumn("own", F.lit(False)))
    y = others.join(bounds, "cid").select("s", F.col("g").alias("yg"), "own", *_side("y", "m"))
    meet = (F.col("xg") != F.col("yg")) & (F.col("own") | (F.col("x_cid") > F.col("y_cid"))) & _can_link("x", "y")
    rest = x.join(y, (x["s"] == y["s"]) & meet).select(
        F.greatest("x_cid", "y_cid").alias("a"), F.least("x_cid", "y_cid").alias("b")
    )
    seen = tried.frame.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = rest.distinct().join(seen, ["a", "b"], "left_anti")
    links = stage(first.frame.unionAll(_confirmed(rest, sets)), "jaccard-links")
    for done in (able, held, scores, pivots, tried, first, groups, sided, outside, opened):
        done.release()
    return links


def _near(pairs: DataFrame, able: DataFrame) -> DataFrame:
    """The pairs that keep the bounds of similar sets."""
    member = able.select("cid", F.struct("cid", "n", "most", "bits").alias("m"))
    with_a = pairs.join(member.select(F.col("cid").alias("a"), F.col("m").alias("x")), "a")
    with_b = with_a.join(member.select(F.col("cid").alias("b"), F.col("m").alias("y")), "b")
    return with_b.select("a", "b", *_side("x", "x"), *_side("y", "y")).where(_can_link("x", "y")).select("a", "b")
