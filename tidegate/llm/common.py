"""What several operators share: inputs, order over many tasks, checked broadcasts, byte hashes."""

from __future__ import annotations

import gc
import time
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side with at most this many rows may be broadcast, if its rows are short.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text as it is, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is (a shuffle join).

    It is counted, so give it something cheap to read again.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: Keys that have over one in so many of all rows are joined by broadcast; so there are fewer than so many.
HOT_SHARE = 1000
#: Below so many rows, no key is worth it.
HOT_ROWS = 10_000


def join_hot(rows: DataFrame, sides: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the one row of ``sides`` for their keys; ``times`` of a side is how many rows it has.

    Keys with over ``1 / HOT_SHARE`` of all rows, which are fewer than ``HOT_SHARE``, don't go through a shuffle.
    """
    size = sides.agg(F.sum("times").alias("all"), F.max("times").alias("most")).first()
    limit = max(HOT_ROWS, (size["all"] or 0) // HOT_SHARE)
    if (size["most"] or 0) <= limit:
        return rows.join(sides.drop("times"), keys)
    hot = F.broadcast(sides.where(F.col("times") > limit).drop("times"))
    cold = sides.where(F.col("times") <= limit).drop("times")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(rest)


def tasks(spark: SparkSession, times: int = 1) -> int:
    return times * int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are stored and read again.

    Spark drops them when the driver has collected the plans they belong to, which may be long after.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def order_bucket(df: DataFrame, key: str, n: int) -> Column:
    """A number from 0 for each row, ascending with ``key`` and near equal in rows: NULL is in the first.

    The edges are at most ``n`` quantiles.  They are searched in two steps of about ``sqrt(n)``.
    """
    shares = [i / n for i in range(1, n)]
    edges = sorted(set(df.select(F.percentile_approx(key, shares, 10 * n).alias("q")).first()["q"] or []))
    if not edges:
        return F.lit(0)
    wide = max(1, int(len(edges) ** 0.5))
    rows = [edges[i : i + wide] for i in range(0, len(edges), wide)]
    value = F.col(key)

    def below(found: Column) -> Column:
        return F.size(F.filter(found, lambda e: e < value))

    firsts = F.array(*[F.lit(r[0]) for r in rows])
    inner = F.array(*[F.array(*[F.lit(e) for e in r]) for r in rows])
    row = below(firsts)
    bucket = F.when(value.isNull() | (row == 0), F.lit(0)).otherwise(
        (row - 1) * wide + below(F.try_element_at(inner, row))
    )
    return bucket.cast("int")


# Rolling hashes of byte strings, modulo 2**64.  Fixed values: two odd multipliers.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared, ..: kept for the task, longer when asked for."""
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        have = _POWERS[str(base)] = np.multiply.accumulate(factors)
    return have[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a value depends on all bits."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of ``(byte + 1) * BASE**i`` before each position, for ``span_hashes``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings from starts to ends; equal strings have equal hashes."""
    raw = (sums[ends] - sums[starts]) * _powers(BASE_INVERSE, len(sums))[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, so that others of any name cannot clash with what an operator adds."""
    return df.select([F.col(f"`{c}`") for c in columns])
