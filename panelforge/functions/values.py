"""Value-level helpers: sentinels, codes, division and logs with the reference's
semantics, expressed with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def null_if(c, sentinel) -> Column:
    """Sentinel value -> null; every other value (and null) unchanged."""
    c = as_col(c)
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)


def fill_flag(c, value: str = "N") -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def zip3(c) -> Column:
    """First three characters of a ZIP code (shorter strings unchanged)."""
    return F.substring(as_col(c), 1, 3)


def zero_pad(c, width: int = 3) -> Column:
    """Left-pad a code with zeros to ``width``; longer strings are kept whole
    (``lpad`` alone would cut them)."""
    s = as_col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def recode(c, mapping: dict) -> Column:
    """Replace listed values, keep the rest unchanged (like ``DataFrame.replace``)."""
    c = as_col(c)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return c if expr is None else expr.otherwise(c)


def safe_div(a, b) -> Column:
    """IEEE division without ANSI errors: x/0 -> +inf, -inf or NaN; nulls stay null."""
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b == 0, F.when(a > 0, F.lit(float("inf")))
                  .when(a < 0, F.lit(float("-inf")))
                  .otherwise(F.lit(float("nan"))))
            .otherwise(a / b))


def log10p1(c) -> Column:
    """log10(x + 1); null for x + 1 <= 0."""
    return F.log10(as_col(c).cast("double") + F.lit(1.0))


def finite_or_null(c) -> Column:
    """+-inf / NaN -> null (for exports that cannot carry non-finite doubles)."""
    c = as_col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def rint2(c) -> Column:
    """Round to 2 decimals half-to-even on the scaled value (``rint(x*100)/100``)."""
    return F.rint(as_col(c) * 100.0) / 100.0


def floor_to(c, step: float) -> Column:
    """Round down to a multiple of ``step`` (``x // step * step``)."""
    return F.floor(as_col(c) / step) * step


def status_severity(c) -> Column:
    """Delinquency status string -> int rank; ``RA`` ranks above every number."""
    c = as_col(c)
    return F.when(c == "RA", F.lit(999)).otherwise(c.cast("int"))


def severity_status(c) -> Column:
    """Inverse of ``status_severity``."""
    c = as_col(c)
    return F.when(c == 999, F.lit("RA")).otherwise(c.cast("string"))
