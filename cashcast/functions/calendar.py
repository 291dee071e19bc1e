"""Calendar expressions. All return Columns evaluated inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_start(col) -> Column:
    """Monday of the ISO week, as a date (``date_trunc('WEEK')`` truncates to Monday)."""
    return F.date_trunc("WEEK", _c(col).cast("timestamp")).cast("date")


def month_start_from_parts(year, month) -> Column:
    """First day of the month from (year, month) parts."""
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_floor(col) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(_c(col).cast("date"), "MM")


def iso_week(col) -> Column:
    """ISO week number 1..53."""
    return F.weekofyear(_c(col))


def season(month) -> Column:
    """Meteorological season of a month number."""
    m = _c(month)
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").otherwise("autumn"))


def fiscal_year(col) -> Column:
    """Fiscal year as text."""
    return F.year(_c(col)).cast("string")


def fiscal_period(col) -> Column:
    """Fiscal period as two-digit text."""
    return F.lpad(F.month(_c(col)).cast("string"), 2, "0")
