"""Near duplicates by MinHash: minima of many universal hashes, banding, verification, connected components.

A document's set is its distinct runs of ``SHINGLE`` words, as 64-bit hashes.  Two documents are linked if
their sets have a Jaccard similarity of ``PERCENT`` of a hundred; a group is what links connect.

1. One pass over the texts gives size, digest and ``HASHES`` minima of each set.  Equal sets are folded to one
   class, so a large group of copies is one row from here on.
2. ``HASHES / ROWS`` bands of ``ROWS`` minima are buckets.  A pair at the limit misses all of them with a
   probability of 3e-6; above it with less.  Classes that share no bucket are done.
3. The whole sets of the others are made.  Shingles that no other such set has are private.  With ``c`` shared
   ones of ``n``, a set can be linked only with sets of at most ``(180 c - 80 n) / 80`` (80: ``PERCENT``), as the
   private ones of both are apart.  Edited copies with too many edits of their own are done here.
4. Each bucket has a pivot: the member that meets most others, which is mostly the text that the copies were
   made of.  Members are verified against the pivots: by ``BITS`` parities of the set, whose differences are at
   most those of the sets; by their minima, where a pair at the limit falls below ``ENOUGH`` agreements with a
   probability of 4e-7; then on whole sets.  Members that follow the same pivots are of one group.
5. In buckets that are not yet one group, the members outside the group of the pivot meet all members of other
   groups that their sizes and parities allow, and those pairs are verified likewise.  In a settled bucket
   nothing is paired, whatever its size.  No bucket is capped.
6. Groups are the connected components of the links, by large-star and small-star steps.

So a link is confirmed on whole sets, and is missed with a probability under 1e-5, or where sets differ only
in hash collisions of 64 bits.

Texts without words (NULL, empty, blank) have empty sets, which are linked with nothing; a text of fewer than
``SHINGLE`` words has its word sequence as the only shingle.  Rows that share a ``doc_id`` are documents of their
own under one number.  Rows without ``doc_id`` are linked with nothing and have no component.  An empty table gives no
rows.  Other columns are not read.  Memory of a task grows with the longest text, by some fifty times its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import free_shuffles, join_hot, mixed, prefix_sums, span_hashes, text_of
from tidegate.llm.components import components
from tidegate.storage import Staged, stage

SHINGLE = 4
#: Similarity as a fraction of whole numbers, so that no rounding decides.
PERCENT = 80
HASHES, ROWS = 96, 4
#: Agreeing minima of a pair that is worth a look at the whole sets.
ENOUGH = 58
#: Parities of a set, in words of 64 bits.
BITS = 1024
#: Words are hashed in runs of texts with at most so many bytes (or one text).
RUN_BYTES = 1 << 20
#: Minima are taken over runs of sets with at most so many shingles (or one set): a run stays in the cache.
RUN_SHINGLES = 1 << 15

_seeds = mixed(np.arange(1, 2 * HASHES + SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Odd multipliers and offsets of the hashes ``(a x + b) mod 2**64 / 2**32``, and of word places in a shingle.
FACTORS, OFFSETS = _seeds[:HASHES] | np.uint64(1), _seeds[HASHES : 2 * HASHES]
PLACES = _seeds[2 * HASHES :] | np.uint64(1)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id of its group) and ``kept`` for every row."""
    spark = docs.sparkSession
    rows = stage(_signed(docs), "minhash-signed").frame
    classes = stage(
        rows.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("f1", "f2")
        .agg(
            F.min(F.struct("doc_id", "key")).alias("m"),
            F.first("minima").alias("minima"),
            F.count(F.lit(1)).alias("times"),
        )
        .select(F.monotonically_increasing_id().alias("cid"), "f1", "f2", "m.doc_id", "m.key", "minima", "times"),
        "minhash-classes",
    ).frame
    members = stage(_bucket_members(classes), "minhash-members")
    shared = stage(members.frame.groupBy("cid").agg(F.sum("times").alias("score")), "minhash-shared")
    sets = stage(_sets(docs, classes.join(shared.frame, "cid").select("cid", "key")), "minhash-sets")
    free_shuffles(spark)
    known = stage(_linkable(sets.frame, shared.frame), "minhash-linkable")
    links = _links(members.frame, known.frame, classes.select("cid", "minima"), sets.frame)
    for done in (members, shared, known, sets):
        done.release()
    groups = components(links.frame)
    numbers = classes.select("cid", "doc_id", "f1", "f2", "times")
    least = (
        groups.join(numbers.select(F.col("cid").alias("node"), "doc_id"), "node")
        .groupBy("component")
        .agg(F.min("doc_id").alias("first_id"))
    )
    first = groups.join(least, "component").select(F.col("node").alias("cid"), "first_id")
    found = numbers.join(first, "cid", "left").select(
        "f1", "f2", "times", F.coalesce("first_id", "doc_id").alias("component_id")
    )
    named = join_hot(
        rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "f1", "f2"),
        stage(found, "minhash-named").frame,
        ["f1", "f2"],
    ).select("doc_id", "n", "component_id")
    rest = rows.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return named.unionAll(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest ``doc_id``, columns as they were."""
    found = near_duplicates(docs.select("doc_id", "text")).where("NOT kept").select("doc_id").distinct()
    dropped = stage(found, "minhash-dropped").frame
    whole = docs.select(F.struct("*").alias("row"))
    left = whole.join(dropped, F.col("row.doc_id") == dropped["doc_id"], "left_anti")
    return left.select("row.*")


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word runs of each text; words are cut at ASCII white space."""
    out: list[np.ndarray] = []
    run: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        run.append(words)
        size += len(text)
        if size >= RUN_BYTES:
            out += _hashed_run(run)
            run, size = [], 0
    return out + _hashed_run(run)


def _hashed_run(run: list[list[bytes]]) -> list[np.ndarray]:
    line = b" ".join(word for words in run for word in words)
    if not line:
        return [np.zeros(0, np.uint64) for _ in run]
    data = np.frombuffer(line, np.uint8)
    spaces = np.flatnonzero(data == 32)
    word = span_hashes(prefix_sums(data), np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(data)]]))
    placed = [word * p for p in PLACES]
    n = len(word)
    whole = np.zeros(n, dtype=np.uint64)
    for i, part in enumerate(placed):
        whole[: max(0, n - i)] += part[i:]
    whole = mixed(whole)
    out, start = [], 0
    for words in run:
        end = start + len(words)
        if len(words) >= SHINGLE:
            out.append(np.unique(whole[start : end - SHINGLE + 1]))
        elif words:
            # Shorter than any run of the full length: summed over the words it has.
            short = sum((placed[i][start + i] for i in range(len(words))), np.uint64(len(words)))
            out.append(mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest of each hash over each of the (non-empty) sets that lie behind one another in ``values``."""
    out = np.empty((len(starts), HASHES), dtype=np.uint32)
    for i in range(HASHES):
        hashed = values * FACTORS[i]
        hashed += OFFSETS[i]
        hashed >>= np.uint64(32)
        out[:, i] = np.minimum.reduceat(hashed, starts)
    return out


def all_minima(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Minima of each set; none of an empty one."""
    out = [np.zeros(0, np.int32)] * len(sets)
    run: list[int] = []
    size = 0
    for i, found in enumerate([*sets, None]):
        if run and (found is None or size + len(found) > RUN_SHINGLES):
            ends = np.cumsum([len(sets[j]) for j in run])
            part = minima(np.concatenate([sets[j] for j in run]), np.concatenate([[0], ends[:-1]]))
            for j, row in zip(run, part.view(np.int32)):
                out[j] = row
            run, size = [], 0
        if found is not None and len(found):
            run.append(i)
            size += len(found)
    return out


def parities(found: np.ndarray) -> np.ndarray:
    """Bit ``i`` tells whether an odd number of shingles falls on ``i``."""
    counts = np.bincount((found >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS)
    return np.packbits(counts & 1, bitorder="little").view(np.int64)


def _signed(docs: DataFrame) -> DataFrame:
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch["text"].to_pylist())
            digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["key"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(d[0]) for d in digests], pa.int64()),
                    pa.array([int(d[1]) for d in digests], pa.int64()),
                    pa.array(all_minima(sets), pa.list_(pa.int32())),
                ],
                names=["doc_id", "key", "n", "f1", "f2", "minima"],
            )

    return _keyed(docs).mapInArrow(signed, "doc_id long, key long, n long, f1 long, f2 long, minima array<int>")


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key, so that a text can be found again where a ``doc_id`` has several."""
    text = text_of()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("key"), text.alias("text")
    )


def _bucket_members(classes: DataFrame) -> DataFrame:
    """(band, cid, times) of every class in every bucket that holds others, ``times`` being the bucket's size."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // ROWS - 1)), lambda i: F.xxhash64(i, F.slice("minima", i * ROWS + 1, F.lit(ROWS)))
    )
    spread = classes.select("cid", F.explode(keys).alias("band"))
    sizes = spread.groupBy("band").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    sizes = stage(sizes, "minhash-buckets").frame
    return join_hot(spread, sizes.withColumn("size", F.col("times")), ["band"]).select(
        "band", "cid", F.col("size").alias("times")
    )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whole sets of the wanted classes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["cid"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["cid", "n", "hashes", "bits"],
            )

    # Equal rows share a key; one of them is read.  The join has dealt the rows by key already.
    texts = _keyed(docs).select("key", "text").join(wanted, "key").dropDuplicates(["key"]).select("cid", "text")
    return texts.mapInArrow(made, "cid long, n long, hashes array<bigint>, bits array<bigint>")


def _linkable(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(cid, n, most, score, bits): the largest size of a set that each could be linked with, where there is any."""
    spread = sets.select("cid", F.explode("hashes").alias("h"))
    single = spread.groupBy("h").agg(F.count(F.lit(1)).alias("times"), F.min("cid").alias("cid")).where("times = 1")
    private = single.groupBy("cid").agg(F.count(F.lit(1)).alias("private"))
    common = F.col("n") - F.coalesce("private", F.lit(0))
    most = F.floor(((100 + PERCENT) * common - PERCENT * F.col("n")) / PERCENT)
    return (
        sets.select("cid", "n", "bits")
        .join(private, "cid", "left")
        .join(shared, "cid")
        .select("cid", "n", most.alias("most"), "score", "bits")
        .where(100 * F.col("most") >= PERCENT * F.col("n"))
    )


def _side(name: str, struct: str) -> list[Column]:
    """The fields of a member as columns of their own: a join condition reads these much faster than an array."""
    plain = [F.col(f"{struct}.{c}").alias(f"{name}_{c}") for c in ("cid", "n", "most")]
    return plain + [F.col(f"{struct}.bits")[i].alias(f"{name}_{i}") for i in range(BITS // 64)]


def _can_link(a: str, b: str) -> Column:
    """Bounds that similar sets keep: sizes, private shingles, parities."""
    one, two = F.col(f"{a}_n"), F.col(f"{b}_n")
    apart = reduce(add, [F.bit_count(F.col(f"{a}_{i}").bitwiseXOR(F.col(f"{b}_{i}"))) for i in range(BITS // 64)])
    return (
        (one <= F.col(f"{b}_most"))
        & (two <= F.col(f"{a}_most"))
        & (100 * F.least(one, two) >= PERCENT * F.greatest(one, two))
        & (apart * (100 + PERCENT) <= (one + two) * (100 - PERCENT))
    )


def _links(members: DataFrame, known: DataFrame, minima: DataFrame, sets: DataFrame) -> Staged:
    """Links (a, b) that connect exactly what the links between all similar sets connect."""
    able = stage(
        members.join(known, "cid").select("band", F.struct("cid", "n", "most", "score", "bits").alias("m")), "minhash-able"
    )
    pivots = able.frame.groupBy("band").agg(
        F.max(F.struct(F.col("m.score").alias("score"), F.col("m.cid").alias("cid"))).alias("p"),
        F.count(F.lit(1)).alias("times"),
    )
    central = known.select("cid", F.struct("cid", "n", "most", "score", "bits").alias("p"))
    pivots = pivots.where("times > 1").select("band", "times", "p.cid").join(central, "cid").drop("cid")
    pivots = stage(pivots, "minhash-pivots")
    met = join_hot(able.frame, pivots.frame, ["band"]).select(*_side("m", "m"), *_side("p", "p"))
    met = met.where("m_cid <> p_cid").where(_can_link("m", "p"))
    pairs = met.select(F.col("m_cid").alias("a"), F.col("p_cid").alias("b")).distinct()
    tried = stage(_alike(pairs, minima), "minhash-tried")
    first = stage(_confirmed(tried.frame, sets), "minhash-first")
    groups = stage(_followed(first.frame, known), "minhash-groups")

    labelled = able.frame.withColumn("cid", F.col("m.cid")).join(groups.frame, "cid", "left").select(
        "band", "m", F.coalesce("g", "cid").alias("g")
    )
    labelled = stage(labelled, "minhash-labelled")
    of_pivot = pivots.frame.withColumn("cid", F.col("p.cid")).join(groups.frame, "cid", "left").select(
        "band", "times", F.coalesce("g", "cid").alias("pg")
    )
    sided = join_hot(labelled.frame, of_pivot, ["band"])
    outside = stage(sided.where("g <> pg").select("band", "m", "g"), "minhash-outside")
    # Members of the pivot's group meet only those outside; two outside meet once.
    opened = outside.frame.groupBy("band").agg(F.count(F.lit(1)).alias("times"))
    inside = join_hot(sided.where("g = pg").select("band", "m", "g"), stage(opened, "minhash-open").frame, ["band"])
    x = outside.frame.select("band", F.col("g").alias("xg"), *_side("x", "m"))
    others = inside.withColumn("own", F.lit(True)).unionByName(outside.frame.withColumn("own", F.lit(False)))
    y = others.select("band", F.col("g").alias("yg"), "own", *_side("y", "m"))
    meet = (F.col("xg") != F.col("yg")) & (F.col("own") | (F.col("x_cid") > F.col("y_cid"))) & _can_link("x", "y")
    rest = x.join(y, (x["band"] == y["band"]) & meet).select(
        F.greatest("x_cid", "y_cid").alias("a"), F.least("x_cid", "y_cid").alias("b")
    )
    seen = tried.frame.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = _alike(rest.distinct().join(seen, ["a", "b"], "left_anti"), minima)
    links = stage(first.frame.unionAll(_confirmed(rest, sets)), "minhash-links")
    for done in (able, pivots, tried, first, groups, labelled, outside):
        done.release()
    return links


def _followed(links: DataFrame, known: DataFrame) -> DataFrame:
    """(cid, g): members with one ``g`` are connected.  Each follows its most central pivot, in up to four steps."""
    best = F.max(F.struct("score", F.col("b").alias("cid")))
    parents = links.join(known.select(F.col("cid").alias("b"), "score"), "b").groupBy("a").agg(best.alias("p"))
    parents = parents.select(F.col("a").alias("cid"), F.col("p.cid").alias("g"))
    for _ in range(2):
        further = parents.select(F.col("cid").alias("g"), F.col("g").alias("next"))
        parents = parents.join(further, "g", "left").select("cid", F.coalesce("next", "g").alias("g"))
    return parents


def _alike(pairs: DataFrame, minima: DataFrame) -> DataFrame:
    """Pairs of which enough minima agree."""
    agree = F.aggregate(F.zip_with("ma", "mb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    return (
        pairs.join(minima.select(F.col("cid").alias("a"), F.col("minima").alias("ma")), "a")
        .join(minima.select(F.col("cid").alias("b"), F.col("minima").alias("mb")), "b")
        .where(agree >= ENOUGH)
        .select("a", "b")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sets are similar: 100 * intersection >= PERCENT * union."""
    one = sets.select(F.col("cid").alias("a"), F.col("hashes").alias("ha"))
    two = sets.select(F.col("cid").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - both
    return pairs.join(one, "a").join(two, "b").where(100 * both >= PERCENT * union).select("a", "b")
