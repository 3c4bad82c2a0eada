"""A corpus pipeline of five operators: toxicity, near duplicates, contamination, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import decontaminate, jaccard_join, mixing, token_blocks, toxicity
from tidegate.llm.common import table
from tidegate.llm.queries import tokenizer_path, toxicity_model
from tidegate.storage import fresh_path, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of the whole table, scores under a half."""
    return toxicity.keep_clean(docs, toxicity_model(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, the one with the smallest id."""
    return jaccard_join.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is passages of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.repeated(mixing.mix(docs))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what is read back from them."""
    path = fresh_path(spark, "token-segments")
    token_blocks.write_segments(docs, path, tokenizer_path())
    return token_blocks.read_documents(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token files", write_tokens),
]

#: SQL cannot train the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-")).frame
    return docs
