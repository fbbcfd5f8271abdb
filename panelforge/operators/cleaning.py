"""Cleaning of raw origination and performance records: one projection each.

Order inside the origination projection follows the data dictionary rules:
the ZIP code is cut to three characters before the ``'00'`` sentinel test, and
the valuation-method recode runs after ``'9'`` became null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import fill_flag, month_end, null_if, recode, zip3


def _project(df: DataFrame, exprs: dict) -> DataFrame:
    """Replace columns in place, keeping the column order; absent columns are skipped."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def clean_origination(df: DataFrame, sentinels: dict | None = None,
                      month_fmt: str = "yyyyMM") -> DataFrame:
    sentinels = C.ORIGINATION_SENTINELS if sentinels is None else sentinels
    cols = set(df.columns)
    ex = {}
    if "First_Payment_Month" in cols:
        ex["First_Payment_Month"] = month_end("First_Payment_Month", month_fmt)
    for c, v in sentinels.items():
        if c in cols:
            base = zip3(c) if c == "ZIP_Code" else F.col(c)
            ex[c] = null_if(base, v)
    if "ZIP_Code" in cols and "ZIP_Code" not in ex:
        ex["ZIP_Code"] = zip3("ZIP_Code")
    for c in C.ORIGINATION_FLAG_DEFAULTS:
        if c in cols:
            ex[c] = fill_flag(c)
    if "Property_Val_Meth" in cols:
        pvm = ex.get("Property_Val_Meth", F.col("Property_Val_Meth"))
        ex["Property_Val_Meth"] = recode(pvm, C.PROPERTY_VAL_METH_CODES)
    return _project(df, ex)


def clean_performance(df: DataFrame, month_fmt: str = "yyyyMM") -> DataFrame:
    cols = set(df.columns)
    ex = {}
    if "Month" in cols:
        ex["Month"] = month_end("Month", month_fmt)
    for c, v in C.PERFORMANCE_SENTINELS.items():
        if c in cols:
            ex[c] = null_if(c, v)
    for c in C.PERFORMANCE_FLAG_DEFAULTS:
        if c in cols:
            ex[c] = fill_flag(c)
    return _project(df, ex)
