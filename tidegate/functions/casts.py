"""Casts that turn a bad text into NULL without paying for an exception per bad row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EDGE = r"[\s\p{Cntrl}]*"
# What a text must look like to be worth a cast.  Each pattern lets through every text the cast accepts,
# and some it refuses, so it never changes a result: it only keeps bad texts away from the slow path.
# Decimals and floats have none: there a bad text costs little, and a pattern would slow every good one.
_WHOLE = rf"^{_EDGE}[+-]?[0-9]+{_EDGE}$"
_BOOLEAN = rf"^{_EDGE}([tTyY1].{{0,3}}|[fFnN0].{{0,4}}){_EDGE}$"


def lenient_cast(column: Column, source: T.DataType, target: T.DataType | str) -> Column:
    """``try_cast`` of ``column``, whose type is ``source``."""
    if isinstance(target, str):
        target = T.DataType.fromDDL(target)
    cast = column.try_cast(target)
    pattern = _pattern(target) if isinstance(source, T.StringType) else None
    return cast if pattern is None else F.when(column.rlike(pattern), cast)


def _pattern(target: T.DataType) -> str | None:
    if isinstance(target, T.IntegralType):
        return _WHOLE
    if isinstance(target, T.BooleanType):
        return _BOOLEAN
    return None
