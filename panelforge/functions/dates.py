"""Calendar helpers. All are built-in Column expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def month_end(c, fmt: str = "yyyyMM") -> Column:
    """Parse a month string (``YYYYMM`` by default, ``yyyy-MM`` for the economic files)
    and snap it to the last day of that month."""
    return F.last_day(F.to_date(as_col(c), fmt))


def to_month_end(c) -> Column:
    """Date or timestamp -> last day of its month."""
    return F.last_day(F.to_date(as_col(c)))


def month_index(c) -> Column:
    """Integer month number ``year*12 + month``; equal steps between calendar months.
    Used as the ordering key of month-based range frames."""
    c = as_col(c)
    return F.year(c) * 12 + F.month(c)


def release_lag(c, months: int) -> Column:
    """Shift a month-end date by ``months`` and snap to month end (publication calendar)."""
    return F.last_day(F.add_months(as_col(c), months))


def quarter_end(year, quarter) -> Column:
    """Year and quarter number -> last day of the quarter's last month."""
    return F.last_day(F.make_date(as_col(year).cast("int"), as_col(quarter).cast("int") * 3, F.lit(1)))


def period_to_month(year, period) -> Column:
    """Year + monthly period code ``Mnn`` -> month end. Other codes (S01/S02 half-years,
    M13 annual averages) give null; callers drop them with ``is_monthly_period``."""
    p = as_col(period)
    return F.when(is_monthly_period(p),
                  F.last_day(F.make_date(as_col(year).cast("int"),
                                         F.substring(p, 2, 2).cast("int"), F.lit(1))))


def is_monthly_period(period) -> Column:
    """True for ``M01`` .. ``M12``."""
    return as_col(period).rlike("^M(0[1-9]|1[0-2])$")


def feb28_after_leap(c) -> Column:
    """True on 28 February of a year that follows a leap year. On those dates a
    right-closed twelve-month window ``(t - 12 months, t]`` starts on 28 Feb of the
    leap year and so also holds 29 Feb: thirteen month-ends instead of twelve."""
    c = as_col(c)
    prev = F.year(c) - 1
    leap = ((prev % 4 == 0) & (prev % 100 != 0)) | (prev % 400 == 0)
    return (F.month(c) == 2) & (F.dayofmonth(c) == 28) & leap
