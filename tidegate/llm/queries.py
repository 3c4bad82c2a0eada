"""The queries of the operators over whole tables: digests of what the operators return, and SQL for some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    decontaminate,
    fill_in_middle,
    jaccard_join,
    kd_shards,
    minhash,
    mixing,
    pii,
    prefix_trie,
    repeats,
    simhash,
    token_blocks,
    toxicity,
    url_cascade,
)
from tidegate.llm.common import table
from tidegate.storage import fresh_path, stage


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


def op1_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir, "doc_id", "text"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(
        simhash.compare_with_edits(_documents(spark, sf_dir, "doc_id", "text")), "simhash"
    ).frame
    asked = found.where(F.col("doc_id") % 50 == 0)
    counts = simhash.near(asked, found)
    # The neighbours of a fingerprint stand beside the first of its query documents; rows of equal texts
    # would each repeat them.
    first = asked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    searched = asked.select("doc_id", "fp").distinct().join(first, "fp").join(counts, "fp")
    searched = searched.select(
        F.col("doc_id").alias("_id"),
        F.col("fp").alias("_fp"),
        "n_near",
        F.when(F.col("doc_id") == F.col("first_id"), F.col("near_fps")).alias("near_fps"),
    )
    return found.join(
        searched, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")), "left"
    ).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.hex_of("fp").alias("fingerprint"),
        simhash.hex_of("efp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
        F.array_sort(F.transform("near_fps", simhash.hex_of)).alias("near_fingerprints"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(
        _documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: Fixed values of the contract.
URL_RULES = (
    url_cascade.Rule("allow", "com", "/"),
    url_cascade.Rule("block", "example.com", "/en/"),
    url_cascade.Rule("allow", "www.example.com", "/en/"),
    url_cascade.Rule("block", "net", "/es/"),
    url_cascade.Rule("block", "net", "/fr/"),
)


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_classes(_documents(spark, sf_dir, "doc_id", "text"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir, "doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir, "doc_id", "text"))


SHARDS = 8
SHARD_DIMS = ["text_crc32", "size", "chars"]


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(kd_shards.measured(_documents(spark, sf_dir, "doc_id", "text")), "shard-rows").frame
    placed = kd_shards.with_slots(kd_shards.kd_shards(rows, SHARD_DIMS, SHARDS))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-segments")
    token_blocks.write_segments(_documents(spark, sf_dir, "doc_id", "text"), path, tokenizer_path())
    return token_blocks.read_documents(spark, path)


def held_out(column: str = "doc_id"):
    """Rows that no label is learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    training = toxicity.labelled(
        _documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels")
    ).where(~held_out("_id"))
    return toxicity.fit(training)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_documents(spark, sf_dir, "doc_id", "text"), toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    trie = prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns))
    ends = prefix_trie.id_lists_sha256(trie.ends, "end", "conv_id")
    return trie.nodes.join(ends, "end", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_documents(spark, sf_dir, "doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_merge": op1_suffix_merge,
    "op2_simhash": op2_simhash,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_cascade": op4_url_cascade,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_mixing": op6_mixing,
    "op7_pii": op7_pii,
    "op8_kd_shards": op8_kd_shards,
    "op9_token_blocks": op9_token_blocks,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return rf"regexp_extract_all({_lower(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _first_rule(then: Callable[[url_cascade.Rule], str], default: str) -> str:
    longest = sorted(URL_RULES, key=lambda r: -len(r.key))
    whens = [
        f"WHEN ('.' || host) LIKE '%.{r.host}' AND starts_with(path, '{r.path}') THEN '{then(r)}'" for r in longest
    ]
    return f"CASE {' '.join(whens)} ELSE {default} END"


OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("coalesce(text, '')")} AS words FROM benchmark),
starts AS (
    SELECT item, words, least(len(words), {decontaminate.WINDOW}) AS n,
           unnest(range(1, len(words) - least(len(words), {decontaminate.WINDOW}) + 2)) AS pos
    FROM b WHERE len(words) > 0
),
windows AS (SELECT DISTINCT item, n, array_to_string(words[pos:pos + n - 1], ' ') AS w FROM starts),
places AS (
    SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos
    FROM d, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n
),
hits AS (
    SELECT doc_id, pos, n, item
    FROM (SELECT doc_id, pos, n, array_to_string(words[pos:pos + n - 1], ' ') AS w FROM places) JOIN windows USING (n, w)
),
hit_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4_SQL = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, position('://' IN coalesce(url, '')) AS pos FROM pages),
r AS (SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u),
p AS (
    SELECT page_id, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM r
)
SELECT page_id, host, path, {_first_rule(lambda r: r.key, "NULL")} AS rule,
       {_first_rule(lambda r: r.verdict, f"'{url_cascade.ALLOW}'")} AS verdict
FROM p
"""

ORACLE: dict[str, str] = {"op3_decontaminate": OP3_SQL, "op4_url_cascade": OP4_SQL}
