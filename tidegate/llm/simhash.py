"""Document fingerprints by SimHash.  DataFrame operations only.

A text's terms are its runs of ``SHINGLE`` words (a shorter text is one term).  A term votes on each of 64
bits with its weight, the times it occurs: for the bit if its hash has it, against it if not; the
fingerprint has the bits with a majority.  Votes are added two bits to a sum, 32 sums for all 64 bits, so
the votes of a text are one grouped sum in compiled code.

``near_pairs`` finds all pairs of fingerprints within a Hamming radius by block tables: 64 bits are cut into
``BLOCKS`` blocks, and two fingerprints within ``RADIUS`` (13) differ by at most 3 bits in one of the first
two or 2 in one of the others.  So there is a table for each block, keyed by its bits, and a query is looked
up by all keys that near its own.  Tables of exact keys would have to be 105 for keys of 8 or 9 bits at such a radius.
The search is exact for the radius; similar texts are found as often as their fingerprints lie within it.
Equal fingerprints are folded before they are looked up.

Words are what is between ASCII white space, A-Z lower-cased.  NULL, empty and blank texts have no terms
and the fingerprint 0.  Equal texts have equal fingerprints.  Tied votes give 0 bits.  Repeated rows are
each fingerprinted; rows with one ``doc_id`` are ordered by a hash of their text, NULL ids come first.  An
empty table gives no rows.  Columns beside the two named are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import if_small, order_bucket, tasks, text_of
from tidegate.storage import stage

SHINGLE = 5
#: Texts of similarity (Jaccard) 0.8 have a cosine of about 0.89: 9.7 bits apart on average, deviation 2.9.
RADIUS = 13
#: Of 64 bits; 16-bit keys.
BLOCKS = 4
UPPER = "".join(chr(c) for c in range(65, 91))
_PAIR = 0x0000000100000001
_LOW = 0xFFFFFFFF


def words_of(text: Column) -> Column:
    return F.filter(
        F.split(F.translate(text, UPPER, UPPER.lower()), r"[\x20\x09-\x0D]+"), lambda w: w != ""
    )


def term_hashes(words: Column) -> Column:
    """Hashes of the terms, one for each time they occur.  ``words`` must be a column of the input: an
    expression would be worked out again for every term."""
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))


def vote_sums(term: Column) -> list[Column]:
    """Sums that hold, in their halves, how many terms have bit ``j`` and bit ``j + 32``."""
    return [
        F.sum(F.shiftrightunsigned(term, j).bitwiseAND(F.lit(_PAIR))).alias(f"_v{j}") for j in range(32)
    ]


def majority(count: Column) -> Column:
    """The fingerprint from ``vote_sums`` and the number of terms."""
    bits = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"_v{j}").bitwiseAND(F.lit(_LOW))
        high = F.shiftrightunsigned(F.col(f"_v{j}"), 32)
        bits = bits.bitwiseOR(F.when(2 * low > count, F.shiftleft(F.lit(1).cast("long"), j)).otherwise(0))
        bits = bits.bitwiseOR(
            F.when(2 * high > count, F.shiftleft(F.lit(1).cast("long"), j + 32)).otherwise(0)
        )
    return F.coalesce(bits, F.lit(0).cast("long"))


def likeness(one: Column, other: Column) -> Column:
    return F.lit(1.0) - F.bit_count(one.bitwiseXOR(other)) / F.lit(64.0)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows with the text of the next document by ``doc_id``; behind the last comes the first.

    Documents are dealt by ranges of ids, many more than one, and the first row of each range is also given
    to the range before it (``edge`` marks these copies), so no window spans a whole table and the texts
    are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.withColumn("part", order_bucket(docs, "doc_id", tasks(spark, 4)))
    order = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), F.col("tie"))
    firsts = rows.groupBy("part").agg(F.min(order).alias("first"))
    before = F.lag("part").over(W.orderBy("part"))
    last = F.max("part").over(W.partitionBy())
    edges = stage(
        firsts.select(F.col("part").alias("own"), "first", F.coalesce(before, last).alias("goes")),
        "simhash-edges",
    ).frame
    edges = edges.select("own", "goes", F.col("first.doc_id").alias("fid"), F.col("first.tie").alias("ftie"))
    joined = rows.join(if_small(edges), F.col("part") == F.col("own"), "left")
    is_first = F.col("doc_id").eqNullSafe(F.col("fid")) & (F.col("tie") == F.col("ftie"))
    places = F.when(
        is_first,
        F.array(
            F.struct(F.col("part").alias("part"), F.lit(False).alias("edge")),
            F.struct(F.col("goes").alias("part"), F.lit(True).alias("edge")),
        ),
    ).otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("edge"))))
    dealt = joined.select("doc_id", "text", "tie", F.explode(places).alias("p")).select(
        F.col("p.part").alias("part"), F.col("p.edge").alias("edge"), "doc_id", "tie", "text"
    )
    return dealt.withColumn("next_text", F.lead("text").over(_in_order())).withColumn(
        "row", F.row_number().over(_in_order())
    )


def _in_order() -> W:
    return W.partitionBy("part").orderBy(
        "edge", F.col("doc_id").asc_nulls_first(), "tie"
    )


def edited_text() -> Column:
    """The text with its last quarter (of code points, rounded down) replaced by as many of the next one's."""
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    return F.concat(
        F.substring(F.col("text"), F.lit(1), n - quarter),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter),
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they and the next ones are."""
    rows = with_next(docs).select(
        "part", "row", "edge", "doc_id", F.length("text").alias("n_chars"), "text", edited_text().alias("edited")
    )
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    both = rows.select(
        "part", "row", "edge", "doc_id", "n_chars", "edited_sha256",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
                F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")),
            )
        ).alias("v"),
    )
    keys = ["part", "row", "edge", "doc_id", "n_chars", "edited_sha256"]
    both = both.select(*keys, F.col("v.kind").alias("kind"), words_of(F.col("v.t")).alias("words"))
    terms = both.select(*keys, "kind", F.explode_outer(term_hashes(F.col("words"))).alias("term"))
    voted = terms.groupBy(*keys, "kind").agg(F.count("term").alias("n"), *vote_sums(F.col("term")))
    voted = voted.select(*keys, "kind", majority(F.col("n")).alias("fp"))
    pair = voted.groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("efp"),
    )
    following = F.lead("fp").over(W.partitionBy("part").orderBy("row"))
    return (
        pair.withColumn("next_fp", following)
        .where("NOT edge")
        .select(
            "doc_id",
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            "fp",
            "efp",
            likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
            likeness(F.col("fp"), F.coalesce("next_fp", "fp")).alias("near_next"),
        )
    )


def hex_of(fingerprint: Column | str) -> Column:
    column = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def reaches(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """In how many bits a block may differ so that two fingerprints within ``radius`` meet in some block."""
    each, more = divmod(radius, blocks)
    return [each if i <= more else each - 1 for i in range(blocks)]


def block_keys(fingerprint: Column, blocks: int = BLOCKS) -> Column:
    """The key of a fingerprint in the table of each block."""
    width = 64 // blocks
    bits = [F.shiftrightunsigned(fingerprint, i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(blocks)]
    return F.array(*[b + F.lit(i << width) for i, b in enumerate(bits)])


def probes(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Table and flipped bits of every key that a fingerprint is looked up by."""
    width = 64 // blocks
    return [
        (i << width) | sum(1 << b for b in flipped)
        for i, reach in enumerate(reaches(radius, blocks))
        for n in range(reach + 1)
        for flipped in combinations(range(width), n)
    ]


def near_pairs(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Every pair of a query fingerprint (``fp``) and one of ``fingerprints`` (``near_fp``) within ``radius``:
    the bits they are ``apart``, and the rows that have the latter (``n``).  The documents of a pair are the
    rows of either table with its fingerprint, so groups of equal texts make one pair.

    A pair that meets in several tables is given by the first of them only, so nothing has to be made
    distinct.
    """
    width = 64 // blocks
    folded = fingerprints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    table = folded.select(F.col("fp").alias("near_fp"), "n", F.explode(block_keys(F.col("fp"), blocks)).alias("k"))
    asked = queries.select("fp").distinct()
    asked = asked.select("fp", F.explode(F.lit(probes(radius, blocks)).cast("array<long>")).alias("e"))
    asked = asked.select(
        "fp",
        F.shiftright("e", width).cast("int").alias("t"),
        F.expr(
            f"e ^ (shiftrightunsigned(fp, {width} * cast(shiftright(e, {width}) AS int)) & {(1 << width) - 1})"
        ).alias("q"),
    )
    apart = F.col("fp").bitwiseXOR(F.col("near_fp"))
    first = F.lit(-1)
    for i, reach in reversed(list(enumerate(reaches(radius, blocks)))):
        part = F.shiftrightunsigned(apart, i * width).bitwiseAND(F.lit((1 << width) - 1))
        first = F.when(F.bit_count(part) <= reach, i).otherwise(first)
    # Spark takes the exploded keys for as small as the fingerprints and would broadcast them.
    met = asked.hint("merge").join(
        table, (F.col("q") == F.col("k")) & (F.bit_count(apart) <= radius) & (F.col("t") == first)
    )
    return met.select("fp", "near_fp", F.bit_count(apart).alias("apart"), "n")


def near(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """For each query fingerprint (``fp``), the number of rows of ``fingerprints`` within ``radius`` and the
    fingerprints that they have (``near_fps``), its own among them."""
    pairs = near_pairs(queries, fingerprints, radius, blocks)
    return pairs.groupBy("fp").agg(F.sum("n").alias("n_near"), F.collect_list("near_fp").alias("near_fps"))
