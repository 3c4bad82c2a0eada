"""Insert-only merge: source rows whose key the target does not hold are appended."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.names import quoted, quoted_table, resolve_all
from tidegate.operators.sinks import balanced
from tidegate.sources.schema import partition_columns
from tidegate.storage import stage

# A sketch that tracks this many keys finds each one that holds a two-thousandth of the rows, and there
# cannot be more than that many of those.
SKETCH_ITEMS = 2000
SKETCH_TRACKED = 16384
HOT_SHARE = 1 / SKETCH_ITEMS
HOT_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Bits of the filter that is sent to the target: 2**20 words of 64.
FILTER_BITS = 1 << 26
MOST_DIGITS = 38


@dataclass(frozen=True)
class KeyProfile:
    """What one pass over the key columns of a source tells: its size and its heavy keys."""

    rows: int
    key_bytes: int
    hot_hashes: tuple[int, ...]


def profile_keys(
    source: DataFrame, keys: Sequence[str], hot_share: float = HOT_SHARE, hot_rows: int = HOT_ROWS
) -> KeyProfile:
    """Row count, size of the keys, and hashes of keys with ``hot_share`` of the rows and ``hot_rows``.

    One aggregation over the key columns; at most ``SKETCH_ITEMS`` hashes reach the driver.  The
    sketch only picks how the join is run, so an estimate is enough.
    """
    keys = resolve_all(source.columns, keys)
    row = (
        source.select(key_hash(keys).alias("h"), _key_size(source, keys).alias("b"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("b").alias("bytes"),
            F.expr(f"approx_top_k(h, {SKETCH_ITEMS}, {SKETCH_TRACKED})").alias("top"),
        )
        .first()
    )
    limit = max(hot_rows, hot_share * row["rows"])
    return KeyProfile(
        rows=row["rows"],
        key_bytes=row["bytes"] or 0,
        hot_hashes=tuple(item["item"] for item in row["top"] if item["count"] >= limit),
    )


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    key_bytes: int | None = None,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    key_filter: bool = True,
) -> DataFrame:
    """Source rows whose key is not in the target, duplicates and NULL keys included.

    Of the target only the key columns are read, and copies of a key are folded before any shuffle.  Keys of both
    sides are brought to one lossless form first (``normal_forms``), so equal keys are equal whatever types they come
    in, and no others are.  A pass over the source's keys decides how the two meet, and never which rows come
    out; if ``key_bytes`` is known to be small (see ``key_size``), that pass is saved.
    """
    keys = resolve_all(source.columns, keys)
    others = resolve_all(target.columns, keys)
    ours, theirs = [], []
    for key, other in zip(keys, others):
        one, two = normal_forms(source.schema[key].dataType, target.schema[other].dataType)
        ours += one(F.col(quoted(key)))
        theirs += two(F.col(quoted(other)))
    names = [f"_key_{i}" for i in range(len(ours))]
    keyed = source.withColumns(dict(zip(names, ours)))
    known = target.select([c.alias(n) for n, c in zip(names, theirs)])
    profile = None
    if key_bytes is None or key_bytes > broadcast_bytes:
        profile = profile_keys(keyed, names, hot_share, hot_rows)
        key_bytes = profile.key_bytes
    if key_bytes <= broadcast_bytes:
        joined = _by_broadcast(keyed, known, names)
    else:
        if key_filter and profile.rows <= FILTER_BITS // 4:
            known = possible_hits(known, keyed, names)
        joined = _by_shuffle(keyed, known, names, profile.hot_hashes)
    return joined.select([F.col(quoted(c)) for c in source.columns])


def normal_forms(one: T.DataType, two: T.DataType) -> tuple[NormalForm, NormalForm]:
    """For each of two types, how its values become key columns that are equal if and only if the values are.

    Whole numbers meet as longs.  Decimals (and whole numbers) meet in a decimal that holds the digits of both, or,
    where none does, as whole part and fraction.  A double meets whole numbers as a long if it is one, and else
    meets nothing.  A text meets numbers, dates and the like as their text.  Types without a form that loses nothing,
    such as a decimal and a double, are refused.
    """
    if one == two or (isinstance(one, T.StringType) and isinstance(two, T.StringType)):
        return _as_is, _as_is
    kinds = {type(one), type(two)}
    if kinds <= set(_WHOLE_DIGITS):
        return _cast(T.LongType()), _cast(T.LongType())
    if kinds <= {*_WHOLE_DIGITS, T.DecimalType}:
        (whole_1, scale_1), (whole_2, scale_2) = _digits(one), _digits(two)
        whole, scale = max(whole_1, whole_2), max(scale_1, scale_2)
        if whole + scale <= MOST_DIGITS:
            return _cast(T.DecimalType(whole + scale, scale)), _cast(T.DecimalType(whole + scale, scale))
        return _whole_and_fraction(one, scale), _whole_and_fraction(two, scale)
    if kinds == {T.FloatType, T.DoubleType}:
        return _cast(T.DoubleType()), _cast(T.DoubleType())
    if kinds <= {*_WHOLE_DIGITS, T.FloatType, T.DoubleType}:
        return tuple(_cast(T.LongType()) if type(t) in _WHOLE_DIGITS else _long_if_whole for t in (one, two))
    if kinds == {T.DateType, T.TimestampType}:
        return _cast(T.TimestampType()), _cast(T.TimestampType())
    if kinds == {T.StringType, T.BinaryType}:
        return _cast(T.BinaryType()), _cast(T.BinaryType())
    if T.StringType in kinds and not kinds & {T.ArrayType, T.MapType, T.StructType, T.VariantType}:
        return _cast(T.StringType()), _cast(T.StringType())
    raise ValueError(
        f"keys of type {one.simpleString()} and {two.simpleString()} have no common form that loses nothing: "
        "cast one side"
    )


NormalForm = Callable[[Column], list[Column]]
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _as_is(key: Column) -> list[Column]:
    return [key]


def _cast(kind: T.DataType) -> NormalForm:
    return lambda key: [key.cast(kind)]


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _WHOLE_DIGITS[type(kind)], 0


def _whole_and_fraction(kind: T.DataType, scale: int) -> NormalForm:
    """Both parts have the sign of the number; a remainder of decimals is exact."""
    whole, own_scale = _digits(kind)

    def parts(key: Column) -> list[Column]:
        exact = key.cast(T.DecimalType(whole + own_scale, own_scale))
        rest = exact % F.lit(1).cast(T.DecimalType(1, 0))
        down = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
        return [down.cast(T.DecimalType(MOST_DIGITS, 0)), rest.cast(T.DecimalType(MOST_DIGITS, scale))]

    return parts


def _long_if_whole(key: Column) -> list[Column]:
    """The number as a long, if it is one: every double is exact, but not every long is a double."""
    value = key.cast("double")
    fits = (value == F.floor(value)) & (value >= -(2.0**63)) & (value < 2.0**63)
    return [F.when(fits, value.try_cast("long"))]


def key_size(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes that the keys of a row take in a broadcast table, for a sum over the rows."""
    return _key_size(df, resolve_all(df.columns, keys))


def possible_hits(known: DataFrame, source: DataFrame, keys: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``known`` that may have a key of ``source``: all that have one, and few others.

    A Bloom filter of one hash: the bits that the source's keys set are made by an aggregation, as words of 64, and
    broadcast.  There are at most ``bits / 64`` of those, whatever the source holds.  The target's rows look their
    word up where they are read, so only possible hits of a large target are shuffled.
    """
    place = F.pmod(key_hash(keys), F.lit(bits))
    word = F.shiftright(place, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    mask = source.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_mask"))
    looked_up = known.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(mask), "_word")
    return looked_up.where(F.col("_mask").bitwiseAND(F.col("_bit")) != 0).select([F.col(k) for k in keys])


def _by_broadcast(source: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """For a source whose keys measurably fit in memory: neither side is shuffled.

    The source's keys filter the target's where those are read.  What is left of them, without copies,
    is a subset of the source's keys, so it is safe to broadcast as well.
    """
    wanted = source.select([F.col(quoted(k)) for k in keys])
    hits = known.join(F.broadcast(wanted), keys, "left_semi").distinct()
    return source.join(F.broadcast(hits), keys, "left_anti")


def _by_shuffle(
    source: DataFrame, known: DataFrame, keys: list[str], hot_hashes: Sequence[int]
) -> DataFrame:
    """For a source with many keys: both sides are shuffled by key, but for the hot keys.

    Those are few, so the ones the target has can be broadcast, and the rows of a hot key, however
    many, are decided where they are read.
    """
    if not hot_hashes:
        return source.join(known.distinct(), keys, "left_anti")
    hot = key_hash(keys).isin(list(hot_hashes))
    cold_rows = source.where(~hot).join(known.where(~hot).distinct(), keys, "left_anti")
    hot_rows = source.where(hot).join(F.broadcast(known.where(hot).distinct()), keys, "left_anti")
    return cold_rows.unionAll(hot_rows)


def merge_insert(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    staged: bool = True,
    **options,
) -> None:
    """Append the new rows of ``source`` to a catalog table, columns matched by name.

    The source is looked at more than once, so it is staged first, and its keys are measured on the way; turn
    that off for one that is a plain scan.  Rows are only added, so a run that is repeated after it succeeded
    adds nothing.
    """
    table = quoted_table(table)
    target = spark.table(table)
    held = None
    try:
        if staged:
            measured = Observation()
            held = stage(source.observe(measured, F.sum(key_size(source, keys)).alias("key_bytes")), "merge")
            source = held.frame
            options.setdefault("key_bytes", measured.get["key_bytes"] or 0)
        fresh = new_rows(source, target, keys, **options)
        rows = balanced(aligned(fresh, target), partition_columns(spark, table))
        rows.write.insertInto(table, overwrite=False)
    finally:
        if held:
            held.release()


def merged(source: DataFrame, target: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """The target as it is after the merge, for targets that are no catalog table."""
    return target.unionAll(aligned(new_rows(source, target, keys, **options), target))


def aligned(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with the columns of ``target``: all of them by name, none missing, none left over."""
    if len(df.columns) != len(target.columns):
        raise ValueError(f"columns differ: {df.columns} against {target.columns}")
    names = resolve_all(df.columns, target.columns)
    return df.select(
        [
            F.col(quoted(n)).cast(f.dataType).alias(f.name)
            for n, f in zip(names, target.schema.fields)
        ]
    )


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(quoted(k)) for k in keys])


def _key_size(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes of the key of a row: measured for texts and binary, 16 for other plain values, 16 for the row.

    Nested keys can be of any size, so they count as too large to broadcast.
    """
    size = F.lit(16).cast("long")
    for key in keys:
        kind = df.schema[key].dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(quoted(key))), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = size + F.lit(1 << 40)
        else:
            size = size + F.lit(16)
    return size
