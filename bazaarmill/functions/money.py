"""Exact decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

AMOUNT = "decimal(12,2)"
UNIT = "decimal(10,2)"
RATE = "decimal(5,2)"
TOTAL = "decimal(22,2)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def amount(x: Column | str) -> Column:
    return _c(x).cast(AMOUNT)


def total(x: Column | str) -> Column:
    """Sum of an exact amount in a fixed, wide type."""
    return F.sum(_c(x)).cast(TOTAL)


def mean(x: Column | str) -> Column:
    """Average of an exact amount: exact sum, one division at the end."""
    return F.sum(_c(x)).cast("double") / F.count(_c(x))


def share(part: Column | str, whole: Column | str) -> Column:
    """Percentage with two decimals, half up; null when the whole is zero."""
    p = _c(part).cast("decimal(20,0)") * F.lit(100)
    return (p / F.nullif(_c(whole).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))).cast(RATE)


def clamp(x: Column | str, low: object, high: object) -> Column:
    low, high = (v if isinstance(v, Column) else F.lit(v) for v in (low, high))
    return F.least(F.greatest(_c(x), low), high)


def naira(x: Column | str) -> Column:
    """Currency text for display; keep the number next to it for further work."""
    return F.concat(F.lit("₦"), F.format_number(_c(x), 2))
