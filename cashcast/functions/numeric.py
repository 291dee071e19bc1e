"""Numeric expressions (rounding, clamps, defaults, ids, currency)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def validity_value(date_col) -> Column:
    """Epoch seconds of UTC midnight of a date, as decimal(21,7). Time-zone free."""
    return (F.unix_date(_c(date_col)).cast("decimal(21,7)") * F.lit(86400)).cast("decimal(21,7)")


def clamp(col, lo, hi) -> Column:
    """X11: ``max(lo, min(x, hi))``."""
    return F.greatest(F.lit(lo), F.least(_c(col), F.lit(hi)))


def padded_id(prefix: str, n, width: int = 6) -> Column:
    """``PREFIX-000001`` style id; ``format_string`` never truncates wide numbers."""
    return F.format_string(f"{prefix}%0{width}d", _c(n).cast("long"))


def padded(n, width: int = 6) -> Column:
    """Zero-padded number as text."""
    return F.format_string(f"%0{width}d", _c(n).cast("long"))


def month_angle(month) -> Column:
    """``2*pi*(m-1)/12``."""
    return F.lit(2.0) * F.pi() * (_c(month).cast("double") - F.lit(1.0)) / F.lit(12.0)


def safe_pct(numerator, denominator, digits: int = 2) -> Column:
    """``round(|num| / den * 100, digits)``; null when den is null or 0 (ANSI-safe)."""
    return F.round(F.try_divide(F.abs(_c(numerator)), _c(denominator)) * F.lit(100), digits)


def exact_mean(col, precision: int = 18, scale: int = 2) -> Column:
    """Mean of values with at most ``scale`` decimals: the exact decimal sum over the
    count, as a double. Unlike a floating-point ``avg`` it does not depend on the order
    in which partitions are combined. Nulls are skipped (aggregate)."""
    v = _c(col).cast(f"decimal({precision},{scale})")
    return F.sum(v).cast("double") / F.count(v).cast("double")
