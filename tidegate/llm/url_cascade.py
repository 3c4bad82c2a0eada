"""URL rules kept in Bloom filter cascades: exact membership without a join.

A rule is a host (it fits all subdomains as well) and the start of a path.  What a url could match is
known from the url: every suffix of its host at a dot, with the start of its path at each length that
rules have.  These keys of all urls are the universe.  For each verdict a cascade holds the rules of it:
level 1 is a Bloom filter of the listed keys, level 2 one of the universe's other keys that pass level 1,
level 3 one of the listed keys that pass level 2, and so on until nothing passes by mistake.  A key is
then listed if the first level that turns it down is an even one.  Within the universe that is exact.

Level 1 has the false positive rate that keeps level 2 as small as the list, so the size follows the list
and only the logarithm of the universe.  Filters are set up from positions that tasks fold together, and
sent to the tasks as bit arrays; ``MAX_BITS`` bounds them, and a list that needs more is refused.

A url that no rule fits is on no list and gets ``default``.  NULL urls and urls without ``://`` have an
empty host and path, match nothing and get ``default``.  Repeated urls are decided alike.  Empty tables
give no rows.  Columns of the input that are not asked for are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.storage import stage

MAX_BITS = 1 << 30
#: Levels halve what passes by mistake, so this many are never reached.
MAX_LEVELS = 200
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return f"{self.host}{self.path}"


@dataclass(frozen=True)
class Level:
    bits: np.ndarray
    hashes: int
    seed: int

    def has(self, key: str) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in positions(key, self.seed, self.hashes, len(self.bits) * 8))


def positions(key: str, seed: int, hashes: int, bits: int) -> list[int]:
    digest = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), seed)
    one, two = digest & 0xFFFFFFFFFFFFFFFF, digest >> 64 | 1
    return [(one + i * two) % bits for i in range(hashes)]


def listed(levels: Sequence[Level], key: str) -> bool:
    for i, level in enumerate(levels):
        if not level.has(key):
            return i % 2 == 1
    return len(levels) % 2 == 1


def host_of(url: str = "url") -> Column:
    rest = F.substring_index(F.col(url), "://", 1)
    after = F.expr(f"substring(`{url}`, length(substring_index(`{url}`, '://', 1)) + 4)")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    upper = "".join(chr(c) for c in range(65, 91))
    known = F.col(url).contains("://") & rest.isNotNull()
    return F.when(known, F.translate(host, upper, upper.lower())).otherwise("")


def path_of(url: str = "url") -> Column:
    after = F.expr(f"substring(`{url}`, length(substring_index(`{url}`, '://', 1)) + 4)")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.col(url).contains("://"), path).otherwise("")


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Keys that a rule for this url would have, the longest first; of equal ones the longer host."""
    parts = host.split(".")
    found = []
    for i in range(len(parts)):
        suffix = ".".join(parts[i:])
        for n in lengths:
            if n <= len(path):
                found.append((len(suffix) + n, len(suffix), suffix + path[:n]))
    return [key for _, _, key in sorted(found, key=lambda x: (-x[0], -x[1]))]


def build(universe: DataFrame, keys: Sequence[str]) -> list[Level]:
    """The cascade that tells ``keys`` from all other keys of ``universe`` (a column ``key``, distinct)."""
    spark = universe.sparkSession
    yes = spark.createDataFrame([(k,) for k in sorted(set(keys))], "key string")
    n_yes = yes.count()
    if not n_yes:
        return []
    no = universe.join(F.broadcast(yes), "key", "left_anti") if n_yes <= 100_000 else universe.join(yes, "key", "left_anti")
    no = stage(no, "cascade-others").frame
    n_no = no.count()
    rate = min(0.5, n_yes * math.sqrt(0.5) / max(n_no, 1))
    levels: list[Level] = []
    into, against, size = yes, no, n_yes
    while size and len(levels) < MAX_LEVELS:
        level = _filled(into, size, rate, seed=len(levels) + 1)
        levels.append(level)
        wrong = stage(_passing(against, level), "cascade-level").frame
        into, against, size = wrong, into, wrong.count()
        rate = 0.5
    if size:
        raise RuntimeError("the cascade did not end")
    return levels


def _filled(keys: DataFrame, size: int, rate: float, seed: int) -> Level:
    """A Bloom filter of a column of keys.  Tasks make positions, the sums are words of bits."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(size * 1.4427 * -math.log2(rate) / 64))
    if bits > MAX_BITS:
        raise ValueError(f"a filter of {bits} bits is over the bound of {MAX_BITS}")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [p for key in batch["key"].to_pylist() for p in positions(key, seed, hashes, bits)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["p"])

    words = (
        keys.mapInArrow(places, "p long")
        .groupBy(F.expr("p div 8").alias("byte"))
        .agg(F.bit_or(F.expr("shiftleft(1, cast(p % 8 as int))")).alias("b"))
        .toPandas()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    out[words["byte"].to_numpy(dtype=np.int64)] = words["b"].to_numpy(dtype=np.uint8)
    return Level(out, hashes, seed)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [key for key in batch["key"].to_pylist() if level.has(key)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])

    return keys.mapInArrow(passing, "key string")


def universe_of(parsed: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """All distinct keys that urls, given by host and path, could match."""
    lengths = list(lengths)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {
                key
                for host, path in zip(batch["host"].to_pylist(), batch["start"].to_pylist())
                for key in candidates(host, path, lengths)
            }
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["key"])

    longest = max(lengths, default=0)
    starts = parsed.select("host", F.substring("path", 1, longest).alias("start")).distinct()
    return starts.mapInArrow(keys, "key string").distinct()


def judge(
    pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Host, path, the longest rule that fits (or NULL) and the verdict for every row of ``pages``.

    Two rules with one host and path must agree; of equally long rules the one with the longer host wins.
    """
    spark: SparkSession = pages.sparkSession
    verdicts = sorted({r.verdict for r in rules})
    if len({r.key for r in rules}) < len({(r.verdict, r.key) for r in rules}):
        raise ValueError("two rules with one key disagree")
    lengths = sorted({len(r.path) for r in rules})
    parsed = pages.select(key, host_of(url).alias("host"), path_of(url).alias("path"))
    universe = stage(universe_of(parsed, lengths), "cascade-universe").frame
    cascades = {v: build(universe, [r.key for r in rules if r.verdict == v]) for v in verdicts}
    sent = spark.sparkContext.broadcast(cascades)
    decide = _decider(lengths, default)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sent.value
        for batch in batches:
            found = [decide(levels, h, p) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[key],
                    batch["host"],
                    batch["path"],
                    pa.array([r for r, _ in found], pa.string()),
                    pa.array([v for _, v in found], pa.string()),
                ],
                names=[key, "host", "path", "rule", "verdict"],
            )

    kind = parsed.schema[key].dataType.simpleString()
    return parsed.mapInArrow(judged, f"`{key}` {kind}, host string, path string, rule string, verdict string")


def _decider(lengths: Sequence[int], default: str) -> Callable:
    lengths = list(lengths)

    def decide(levels: dict[str, list[Level]], host: str, path: str) -> tuple[str | None, str]:
        for key in candidates(host, path, lengths):
            for verdict, cascade in levels.items():
                if cascade and listed(cascade, key):
                    return key, verdict
        return None, default

    return decide
