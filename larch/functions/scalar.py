"""Scalar functions (F1-F9) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_week(ts: str | Column) -> Column:
    """ISO-8601 week number (2022-01-01 is week 52)."""
    return F.weekofyear(_c(ts))


def day_of_month(ts: str | Column) -> Column:
    """F2."""
    return F.dayofmonth(_c(ts))


def hour_of_day(ts: str | Column) -> Column:
    """F3."""
    return F.hour(_c(ts))


def minute_of_hour(ts: str | Column) -> Column:
    """F4."""
    return F.minute(_c(ts))


def weekday_monday0(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6 (not ``dayofweek``, which is Sunday = 1)."""
    return F.weekday(_c(ts))


def pair_key(a: str | Column, b: str | Column, sep: str = "_") -> Column:
    """``a + sep + b``; NULL when either side is NULL."""
    return F.concat(_c(a), F.lit(sep), _c(b))


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Fractional minutes (microsecond precision, no truncation)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60000000.0)


def neg_log10(c: str | Column) -> Column:
    """F8: axis of a coefficient path."""
    return -F.log10(_c(c))


def label_from_p0(p0: str | Column, threshold: float = 0.5) -> Column:
    """0 when P(class 0) >= threshold, else 1 (raising the threshold
    gives more 1s)."""
    return F.when(_c(p0) >= F.lit(threshold), F.lit(0)).otherwise(F.lit(1))


def round_all(cols: list[str], digits: int = 6) -> list[Column]:
    return [F.round(F.col(c), digits).alias(c) for c in cols]
