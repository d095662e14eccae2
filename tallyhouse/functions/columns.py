"""Scalar column helpers (all built-in expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_day(x) -> Column:
    """DATE(ts) / CAST(x AS DATE)."""
    return _c(x).cast("date")


def on_or_after(x, day: Column, timestamp: bool = False) -> Column:
    """``CAST(x AS DATE) >= day``; NULL compares false (row dropped).

    For a timestamp without time zone this equals ``x >= day 00:00:00``,
    which (unlike the cast) can be pushed to the parquet scan; pass
    ``timestamp=True`` for such columns."""
    if timestamp:
        return _c(x) >= day.cast("timestamp_ntz")
    return to_day(x) >= day


def month_start(x) -> Column:
    """DATE_TRUNC('month', d) as a date."""
    return F.trunc(to_day(x), "month")


def day_before(day: Column) -> Column:
    """DATEADD(day, -1, d)."""
    return F.date_sub(day, 1)


def norm_text(x) -> Column:
    """UPPER(TRIM(x)); TRIM removes spaces only (a tab stays)."""
    return F.upper(F.trim(_c(x)))


def zero(dtype: T.DataType) -> Column:
    """Typed zero so every union branch keeps one column type."""
    return F.lit(0).cast(dtype)
