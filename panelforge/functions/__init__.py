"""Column-expression helpers (all built-in Spark functions)."""

from .dates import (feb28_after_leap, is_monthly_period, month_end, month_index,
                    period_to_month, quarter_end, release_lag, to_month_end)
from .values import (fill_flag, finite_or_null, floor_to, log10p1, null_if, recode,
                     rint2, safe_div, severity_status, status_severity, zero_pad, zip3)

__all__ = [
    "feb28_after_leap", "is_monthly_period", "month_end", "month_index", "period_to_month",
    "quarter_end", "release_lag", "to_month_end", "fill_flag", "finite_or_null", "floor_to",
    "log10p1", "null_if", "recode", "rint2", "safe_div", "severity_status", "status_severity",
    "zero_pad", "zip3",
]
