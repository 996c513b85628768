"""Smart date keys (yyyyMMdd integers) and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(d: Column | str) -> Column:
    """yyyyMMdd as int. Arithmetic keeps it inside generated code, without a formatter object."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_of(key: Column | str) -> Column:
    """Date of a yyyyMMdd key."""
    k = _c(key)
    return F.make_date((k / 10000).cast("int"), ((k % 10000) / 100).cast("int"), k % 100)


def us_week(d: Column | str) -> Column:
    """Week of year where week 1 holds January 1 and weeks start on Sunday."""
    d = _c(d)
    return F.ceil((F.dayofyear(d) + F.dayofweek(F.trunc(d, "YEAR")) - 1) / 7).cast("int")


def month_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "EEEE")
