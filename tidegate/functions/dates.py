"""Dates of a run: all of them follow from one ``as_of`` so that a rerun gives the same rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def shifted_day(as_of: datetime, days: int, pattern: str) -> str:
    """``as_of`` moved by ``days``, as text in a ``strftime`` pattern."""
    return (as_of + timedelta(days=days)).strftime(pattern)


def day_text(value: Column | str) -> Column:
    """A date or timestamp as ``yyyyMMdd`` text.

    The cast to date comes first, so a timestamp without zone keeps its own day in every session zone.
    """
    return F.date_format(_column(value).cast("date"), "yyyyMMdd")


def day_key(value: Column | str) -> Column:
    """A date or timestamp as the integer ``yyyyMMdd``; integer arithmetic only, no text in between."""
    day = _column(value).cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def stamp_literal(as_of: datetime) -> Column:
    """``as_of`` as a timestamp constant, read as wall-clock time of the session's zone."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
