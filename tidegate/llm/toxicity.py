"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are character n-grams of a text, lower-cased, runs of white space made one space and the ends marked
by one, so n-grams cross spaces.  They are hashed to ``2**BITS`` columns; a column is in a text or not.

1. Over all labelled training rows, tasks count in how many documents of either label each column is seen;
   the sums (two numbers a column) come to the driver and give the log-count ratios ``r``.  Columns seen in
   under ``MIN_DOCS`` documents have the ratio 0, so they say nothing.
2. A text is the vector of ``r`` at its columns, scaled to length one.  Logistic regression fits one weight
   a column, by accelerated gradient steps with a ridge ``RIDGE``, labels weighted alike.  It is fitted on at
   most ``FIT_ROWS`` training rows of each label, those with the smallest hashes of their ids and texts, and
   of these only as many as keep the sum of their lengths under ``FIT_CHARS``.  That is the
   documented bound of the fit; the ratios, and all scores, cover all rows.
3. Every document is scored over its whole text.

Labels other than 0 and 1 are left out; a document with several label rows counts with each.  NULL, empty
and blank texts, and others without a column that has a ratio, score the share of label 1 in the training
rows.  So does everything if one of the labels has no training row (0.5 without any).  Texts of any length
are read whole; a text takes memory in proportion to its length, one at a time.  Repeated rows are scored
each and alike; an empty table has no scores.  Ids are compared as text.  Columns of the input beside
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import free_shuffles, text_of
from tidegate.storage import stage

BITS = 18
SIZES = (4, 5)
MIN_DOCS = 3
SMOOTHING = 1.0
FIT_ROWS = 2000
FIT_CHARS = 20_000_000
RIDGE = 1e-4
STEPS = 80
#: Rows of the fit that are multiplied at a time.
CHUNK = 256


@dataclass(frozen=True)
class Model:
    """The ratio of every column, its fitted weight, and the score of a text that says nothing."""

    ratio: np.ndarray
    weight: np.ndarray
    intercept: float
    share: float


def columns_of(text: str) -> np.ndarray:
    """The distinct columns of a text's n-grams, ascending."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int32)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(1 << BITS, dtype=bool)
    hashes = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, min(SIZES[-1], len(codes)) + 1):
        hashes = hashes[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] * np.uint32(0x9E3779B1)
        if n >= SIZES[0]:
            found = hashes ^ (hashes >> np.uint32(15))
            seen[(found * np.uint32(0x85EBCA77) + np.uint32(n)) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with their label; ids are compared as text, so their types may differ.

    Both grow with the corpus, so they meet in one shuffle at every size.
    """
    known = labels.where("toxic IN (0, 1)").select(
        F.col("doc_id").cast("string").alias("_id"), F.col("toxic").cast("int").alias("toxic")
    )
    texts = docs.select(F.col("doc_id").cast("string").alias("_id"), text_of().alias("text"))
    return texts.join(known.hint("merge"), "_id")


def fit(training: DataFrame) -> Model:
    """``training`` has ``_id``, ``text`` and ``toxic``; it is made once, and staged while the fit runs."""
    spark = training.sparkSession
    staged = stage(training.select("_id", "text", "toxic"), "toxicity-training")
    free_shuffles(spark)
    counts, rows = _counts(staged.frame)
    share = float(rows[1] / rows.sum()) if rows.sum() else 0.5
    if not rows[0] or not rows[1]:
        nothing = np.zeros(1 << BITS)
        model = Model(nothing, nothing, 0.0, share)
    else:
        toxic = (counts[1] + SMOOTHING) / (rows[1] + 2 * SMOOTHING)
        clean = (counts[0] + SMOOTHING) / (rows[0] + 2 * SMOOTHING)
        ratio = np.log(toxic / (1 - toxic)) - np.log(clean / (1 - clean))
        ratio[counts.sum(axis=0) < MIN_DOCS] = 0.0
        weight, intercept = _regression(*_sample(staged.frame, ratio), ratio)
        model = Model(ratio, weight, intercept, share)
    staged.release()
    return model


def _sample(training: DataFrame, ratio: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns with a ratio, and labels, of the rows of the fit.  Rows are chosen by narrow columns alone."""
    keyed = training.withColumn("h", F.xxhash64("_id", "text")).withColumn("size", F.length("text"))
    chosen = []
    for label in (0, 1):
        one = keyed.where(F.col("toxic") == label).select("h", "size").orderBy("h", "size").limit(FIT_ROWS)
        room = FIT_CHARS // 2
        for row in one.collect():
            room -= row["size"]
            if room < 0:
                break
            chosen.append((row["h"], label))
    spark = training.sparkSession
    wanted = spark.createDataFrame(sorted(set(chosen)), "h long, toxic int")
    sent = spark.sparkContext.broadcast(ratio != 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [columns_of(t) for t in batch["text"].to_pylist()]
            found = [c[sent.value[c]] for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch["h"], batch["toxic"], pa.array(found, pa.list_(pa.int32()))], names=["h", "toxic", "c"]
            )

    rows = keyed.select("h", "toxic", "text").join(F.broadcast(wanted), ["h", "toxic"])
    # Repeated rows share a hash; each row chosen counts once.
    cut_rows = rows.dropDuplicates(["h", "toxic"]).mapInArrow(cut, "h long, toxic int, c array<int>")
    found = cut_rows.toArrow().sort_by([("h", "ascending"), ("toxic", "ascending")])
    columns = [c for chunk in found["c"].chunks for c in _parts(chunk)]
    kept = [i for i, c in enumerate(columns) if len(c)]
    labels = found["toxic"].to_numpy()
    return [columns[i] for i in kept], labels[kept].astype(float)


def _parts(lists: pa.ListArray) -> list[np.ndarray]:
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1])


def _counts(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), dtype=np.int64)
        rows = np.zeros(2, dtype=np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                rows[toxic] += 1
                seen[toxic][columns_of(text)] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(at, -1), pa.int64()),
                pa.array(np.append(seen[0][at], rows[0]), pa.int64()),
                pa.array(np.append(seen[1][at], rows[1]), pa.int64()),
            ],
            names=["c", "n0", "n1"],
        )

    sums = (
        training.select("text", "toxic")
        .mapInArrow(count, "c long, n0 long, n1 long")
        .groupBy("c")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toPandas()
    )
    out = np.zeros((2, 1 << BITS))
    rows = np.zeros(2)
    if len(sums):
        at = sums["c"].to_numpy(np.int64)
        for i in (0, 1):
            n = sums[f"n{i}"].to_numpy(float)
            rows[i] = n[at < 0].sum()
            out[i][at[at >= 0]] = n[at >= 0]
    return out, rows


class Rows:
    """The vectors of the fit, kept as columns alone: their values follow from the ratios."""

    def __init__(self, columns: list[np.ndarray], ratio: np.ndarray):
        self.ratio = ratio
        lengths = np.array([np.sqrt((ratio[c] ** 2).sum()) for c in columns])
        self.chunks = [
            (i, columns[i : i + CHUNK], 1 / lengths[i : i + CHUNK]) for i in range(0, len(columns), CHUNK)
        ]
        self.n = len(columns)

    def times(self, weight: np.ndarray) -> np.ndarray:
        scaled = weight * self.ratio
        return np.concatenate([[scaled[c].sum() * x for c, x in zip(cs, xs)] for _, cs, xs in self.chunks])

    def back(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ratio))
        for i, columns, inverse in self.chunks:
            each = np.repeat(values[i : i + len(columns)] * inverse, [len(c) for c in columns])
            out += np.bincount(np.concatenate(columns), weights=each, minlength=len(out))
        return out * self.ratio


def _regression(columns: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with a ridge."""
    weight, intercept = np.zeros(len(ratio)), 0.0
    if not len(y) or y.all() or not y.any():
        return weight, intercept
    rows = Rows(columns, ratio)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    # Vectors have length one, and shares sum to one: no curve of the loss is over (1 + 1) / 4.
    step = 1 / (0.5 + RIDGE)
    ahead, ahead_intercept, pace = weight, intercept, 1.0
    for _ in range(STEPS):
        off = share * (_logistic(rows.times(ahead) + ahead_intercept) - y)
        next_weight = ahead - step * (rows.back(off) + RIDGE * ahead)
        next_intercept = ahead_intercept - step * off.sum()
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        push = (pace - 1) / next_pace
        ahead = next_weight + push * (next_weight - weight)
        ahead_intercept = next_intercept + push * (next_intercept - intercept)
        weight, intercept, pace = next_weight, next_intercept, next_pace
    return weight, float(intercept)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and the score of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score_of(t, sent.value) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(scored, f"doc_id {kind}, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, all columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([score_of(t, sent.value) for t in batch], dtype=float)

    return docs.where(scores(text_of()) < threshold)


def score_of(text: str, model: Model) -> float:
    columns = columns_of(text)
    values = model.ratio[columns]
    length = np.sqrt((values**2).sum())
    if not length:
        return model.share
    return float(_logistic((values * model.weight[columns]).sum() / length + model.intercept))
