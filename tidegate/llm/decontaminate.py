"""Benchmark decontamination: windows of benchmark words looked up in every text.  DataFrame only.

Benchmark items are cut into windows of ``WINDOW`` words; an item of fewer is one window.  All windows
make a hash table: buckets of (window, items) that go to the tasks as a constant of the plan.  A document
is decided in its own row: for each of its words and each window length the window's hash picks a bucket,
and only where the bucket is not empty are the words themselves compared, so a hit is a hit.  A bucket is
a text of (window, items), marked off by control characters, which no word has; item ids stand there in hex, so
they may be any text.  Nothing is shuffled, and a hot passage costs what any other does.

The table is used while the benchmark has at most ``TABLE_BYTES`` of windows.  Beyond that, documents
that hold a window whose hash is in the benchmark are found by a shuffle join on the hash.

Words are ``WORD`` after lower-casing A-Z.  NULL and empty texts have no words, no hits and no items.
Repeated rows are decided each; items with NULL ids count for hits but not as items, and the empty id is an id like
others.  An empty benchmark hits nothing; no documents give no rows.  A text of any length is decided whole,
in memory of ``WINDOW`` times its length.  Columns of the input are kept, whatever their names; those that
``contamination`` adds are named in ``ADDED`` and replace others of these names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import text_of

WINDOW = 13
#: What is between words, after A-Z are lower-cased: the contract's word class turned round.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TABLE_BYTES = 8 << 20
SPARSE = 8
UPPER = "".join(chr(c) for c in range(65, 91))
HITS = "array<struct<at:int,n:int,i:array<string>>>"
ADDED = ("n_words", "hit_words", "n_hit", "items", "contaminated")


def words_of(text: Column) -> Column:
    lowered = F.translate(text, UPPER, UPPER.lower())
    return F.filter(F.split(lowered, BETWEEN), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: their length, words (joined by spaces), hash, and the ids of their items."""
    rows = benchmark.select(
        F.col("item_id").cast("string").alias("item"), words_of(text_of()).alias("words")
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    cut = rows.select("item", "words", length.alias("n"), F.explode(starts).alias("at"))
    return (
        cut.select("item", "n", F.array_join(F.slice("words", F.col("at"), F.col("n")), " ").alias("w"))
        .groupBy("n", "w")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("h", F.xxhash64("w"))
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """``docs`` with the number of words, the places of hit words (from 1), their number, the sorted ids of
    items with occurring windows, and whether at least a twentieth of the words is hit."""
    kept = [f"_doc.`{c}`" for c in docs.columns if c not in ADDED]
    return _judged(docs, benchmark, window, table_bytes).select(*kept, *ADDED)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, columns as they were."""
    judged = _judged(docs, benchmark, window)
    # A plain filter would be pushed below the columns it is made of, and work the words out again for every
    # window; a generator of one row or none is not moved.
    kept = F.when(F.col("contaminated"), F.array().cast("array<int>")).otherwise(F.array(F.lit(1)))
    return judged.withColumn("kept", F.explode(kept)).select("_doc.*")


def clean_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, hit words taken out of their texts with what stands before them."""
    judged = _judged(docs, benchmark, window)
    letters = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    # Columns of their own, so that they are not worked out again for every word.
    parted = judged.withColumn("parts", F.regexp_extract_all("_text", F.lit(letters), F.lit(0))).withColumn(
        "gaps", F.split("_text", letters)
    )
    places = F.when(F.size("parts") > 0, F.sequence(F.lit(1), F.size("parts"))).otherwise(
        F.array().cast("array<int>")
    )
    left = F.transform(
        F.array_except(places, "hit_words"), lambda i: F.concat(F.get("gaps", i - 1), F.get("parts", i - 1))
    )
    rest = F.coalesce(F.get("gaps", F.size("parts")), F.lit(""))
    text = F.when(F.size("hit_words") == 0, F.col("_doc.text")).otherwise(F.concat(F.array_join(left, ""), rest))
    return parted.withColumn("cleaned", text).select(
        [F.col("cleaned").alias(c) if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns]
    )


def _judged(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """The input's rows as ``_doc`` (in one column, so that no name clashes), its texts, and ``ADDED``."""
    windows = benchmark_windows(benchmark, window)
    size = windows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("w") + F.length(F.array_join("items", ",")) + 32).alias("b")
    ).first()
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), text_of().alias("_text"))
    if (size["b"] or 0) <= table_bytes:
        found = _by_table(base, windows, size["n"])
    else:
        found = _by_join(base, windows)
    return _decided(found)


def _starts(words: Column, n_words: int) -> Column:
    """Where windows of a length start, from 1."""
    none = F.array().cast("array<int>")
    return F.when(F.size(words) >= n_words, F.sequence(F.lit(1), F.size(words) - n_words + 1)).otherwise(none)


def _cut(words: Column, n_words: int) -> Callable[[Column], Column]:
    return lambda at: F.struct(at.alias("at"), F.array_join(F.slice(words, at, n_words), " ").alias("w"))


def _by_table(docs: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """Hits found in the row, against a constant of the plan that was measured to be small."""
    buckets = max(1, SPARSE * n)
    rows = windows.collect()
    lengths = sorted({r["n"] for r in rows})
    table = [""] * buckets
    for r in sorted(rows, key=lambda r: (r["n"], r["w"])):
        ids = chr(3).join("i" + i.encode("utf-8").hex() for i in r["items"])
        table[r["h"] % buckets] += f"\x01{r['w']}\x02{ids}"
    held = F.split(F.lit("\n".join(table)), "\n")
    docs = docs.withColumn("_words", words_of(F.col("_text")))
    words = F.col("_words")

    def bucket(w: Column) -> Column:
        return F.get(held, F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))

    def entry(w: Column) -> Column:
        return F.concat(F.lit("\x01"), w, F.lit("\x02"))

    def items(w: Column) -> Column:
        behind = F.get(F.split(bucket(w), F.concat(F.lit("\\Q"), entry(w), F.lit("\\E"))), F.lit(1))
        found = F.substring_index(behind, "\x01", 1)
        marked = F.filter(F.split(found, "\x03"), lambda i: i != "")
        return F.transform(marked, lambda i: F.decode(F.unhex(F.substr(i, F.lit(2))), "UTF-8"))

    def hits_of(n_words: int) -> Column:
        found = F.filter(
            F.transform(_starts(words, n_words), _cut(words, n_words)),
            lambda f: (bucket(f["w"]) != "") & bucket(f["w"]).contains(entry(f["w"])),
        )
        return F.transform(
            found,
            lambda f: F.struct(f["at"].alias("at"), F.lit(n_words).alias("n"), items(f["w"]).alias("i")),
        )

    hits = F.array().cast(HITS)
    for n_words in lengths:
        hits = F.concat(hits, hits_of(n_words))
    return docs.withColumn("n_words", F.size(words).cast("long")).withColumn("_hits", hits).drop("_words")


def _by_join(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Hits found by a shuffle join, for benchmarks of any size."""
    docs = docs.withColumn("_row", F.struct(F.xxhash64("_text"), F.md5("_text"), F.length("_text")))
    texts = docs.select("_row", "_text").groupBy("_row").agg(F.min("_text").alias("_text"))
    texts = texts.select("_row", words_of(F.col("_text")).alias("_words"))
    cut = None
    for n_words in [r["n"] for r in windows.select("n").distinct().collect()]:
        words = F.col("_words")
        found = F.explode(F.transform(_starts(words, n_words), _cut(words, n_words)))
        one = texts.select("_row", F.lit(n_words).alias("n"), found.alias("f"))
        cut = one if cut is None else cut.unionAll(one)
    cut = cut.select("_row", "n", "f.at", "f.w", F.xxhash64("f.w").alias("h"))
    hits = (
        cut.join(windows, ["h", "n", "w"])
        .groupBy("_row")
        .agg(F.collect_list(F.struct("at", "n", F.col("items").alias("i"))).alias("_hits"))
    )
    return (
        docs.join(hits, "_row", "left")
        .withColumn("_hits", F.coalesce("_hits", F.array().cast(HITS)))
        .withColumn("n_words", F.size(words_of(F.col("_text"))).cast("long"))
        .drop("_row")
    )


def _decided(found: DataFrame) -> DataFrame:
    places = F.array_distinct(
        F.flatten(F.transform("_hits", lambda h: F.sequence(h["at"], h["at"] + h["n"] - 1)))
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["i"]))))
    return (
        found.withColumn("hit_words", places)
        .withColumn("items", items)
        .withColumn("n_hit", F.size("hit_words").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("_hits")
    )
