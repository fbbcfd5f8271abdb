"""Loan panel: default label, twelve-month look-back features, ZIP default rate.

Physical plan (checked with ``explain``): the performance rows are hash-partitioned
on the loan id once. The defect flag, the forward label and the five look-back
features are window functions over the same (loan, month index) ordering, so they
share one sort; the origination join reuses that partitioning. A loan's history is
bounded by its term (a few hundred months), so no loan key can grow hot.

The ZIP default rate aggregates ``(scope, ZIP, month)`` partials first (map-side
combine), runs the twelve-month window over that small table and joins the rate
back on its key, without a hint: the planner and AQE choose the join by measured bytes
and split a ZIP-month that holds a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import (feb28_after_leap, log10p1, month_index, safe_div, severity_status,
                         status_severity)

LOAN, MONTH = "Loan_Num", "Month"
STATUS, ZBC = "Current_Delinquency_Status", "Zero_Balance_Code"


def current_default(status: str = STATUS, zbc: str = ZBC) -> Column:
    """1 when the status is >= '3' in *string* order ('RA' counts, '12' does not) or the
    zero-balance code is a default event; null inputs count as no."""
    s, z = F.col(status), F.col(zbc)
    return (F.coalesce(s >= F.lit(C.DEFAULT_STATUS_FLOOR), F.lit(False))
            | F.coalesce(z.isin(*C.DEFAULT_ZERO_BALANCE_CODES), F.lit(False))).cast("int")


def drop_defective(orig: DataFrame, perf: DataFrame, key: str = LOAN, zbc: str = ZBC,
                   code: str = C.DEFECT_ZERO_BALANCE_CODE):
    """Remove loans that ever carry the defect code: anti join on the origination side,
    then keep only performance rows of the surviving loans (semi join)."""
    bad = perf.where(F.col(zbc) == F.lit(code)).select(key)
    orig_ok = orig.join(bad, key, "left_anti")
    perf_ok = perf.join(orig_ok.select(key), key, "left_semi")
    return orig_ok, perf_ok


def semi_join_loans(perf: DataFrame, loans: DataFrame, key: str = LOAN) -> DataFrame:
    """Performance rows of the given loans."""
    return perf.join(loans.select(key), key, "left_semi")


def _frames(part, order: str, strict_calendar: bool):
    """The twelve months up to t, and (strict calendar) month t - 12 alone."""
    w = Window.partitionBy(*part).orderBy(order)
    return w.rangeBetween(-11, 0), (w.rangeBetween(-12, -12) if strict_calendar else None)


def _trailing(agg_fn, col: Column, w12, first, month_col: str) -> Column:
    """Maximum or sum over the right-closed window (t - 12 months, t] on month-end dates.
    With ``first`` (strict calendar) 28 Feb after a leap year also counts month t - 12: one
    more month's frame that joins the twelve months' result, not a second window of 13."""
    base = agg_fn(col).over(w12)
    if first is None:
        return base
    more = agg_fn(col).over(first)
    both = F.greatest(base, more) if agg_fn is F.max else F.coalesce(base + more, base, more)
    return F.when(feb28_after_leap(month_col), both).otherwise(base)


def label_and_lookback(perf: DataFrame, key: str = LOAN, month: str = MONTH,
                       horizon: int = 12, strict_calendar: bool = True,
                       drop_defects: bool = True) -> DataFrame:
    """Forward label and trailing features on cleaned performance rows.

    ``Default`` = max of ``Current_Default`` over the next ``horizon`` rows of the loan
    (current row excluded); rows with fewer than ``horizon`` later rows are dropped.
    The look-back features count calendar months, not rows.
    """
    m = "_m"
    p = perf.withColumn(m, month_index(month)).withColumn("Current_Default", current_default())
    w_rows = Window.partitionBy(key).orderBy(m)
    fwd = w_rows.rowsBetween(1, horizon)
    w12, first = _frames([key], m, strict_calendar)
    sev = status_severity(STATUS)
    is_status = lambda v: (F.col(STATUS) == F.lit(v)).cast("int")
    cols = {
        "Default": F.max("Current_Default").over(fwd),
        "_n_next": F.count(F.lit(1)).over(fwd),
        "Max_Delinq_Severity_yoy": severity_status(_trailing(F.max, sev, w12, first, month)),
        "Num_Modifications_yoy": _trailing(
            F.sum, (F.col("Modification_Flag") == F.lit("Y")).cast("int"), w12, first, month).cast("int"),
        "Delinq_Status_0_Count": _trailing(F.sum, is_status("0"), w12, first, month).cast("int"),
        "Delinq_Status_1_Count": _trailing(F.sum, is_status("1"), w12, first, month).cast("int"),
        "Delinq_Status_2_Count": _trailing(F.sum, is_status("2"), w12, first, month).cast("int"),
    }
    if drop_defects:
        cols["_defect"] = F.max((F.col(ZBC) == F.lit(C.DEFECT_ZERO_BALANCE_CODE)).cast("int")).over(
            w_rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    p = p.withColumns(cols)
    cond = F.col("_n_next") == horizon
    if drop_defects:
        cond = cond & (F.coalesce(F.col("_defect"), F.lit(0)) == 0)
    return p.where(cond).drop("_n_next", "_defect", m)


def forward_default_label(perf: DataFrame, key: str = LOAN, month: str = MONTH,
                          horizon: int = 12) -> DataFrame:
    """Only the forward label (W1) plus the current-default flag."""
    m = "_m"
    w = Window.partitionBy(key).orderBy(m).rowsBetween(1, horizon)
    p = (perf.withColumn(m, month_index(month)).withColumn("Current_Default", current_default())
         .withColumns({"Default": F.max("Current_Default").over(w),
                       "_n_next": F.count(F.lit(1)).over(w)}))
    return p.where(F.col("_n_next") == horizon).drop("_n_next", m)


def zip_default_rate(panel: DataFrame, scope=("Year", "Quarter"), zip_col: str = "ZIP_Code",
                     month: str = MONTH, target: str = "Default", strict_calendar: bool = True,
                     out: str = "ZIP_Default_Rate", lag_months: int = 0) -> DataFrame:
    """Mean of the 0/1 label over all rows of the same ZIP (within ``scope``) whose month
    lies in (t - 12 months, t]; rows of other loans in the same month are included.
    A null ZIP is its own group.

    The rate table has one row per scope, ZIP and month. It is written first, so that the
    planner knows its bytes: a small one is broadcast and the panel's rows stay where they are
    (with its size unknown they were all shuffled before AQE saw it), a large one is joined by
    sort-merge with hot ZIP-months split. ``panel`` is read twice, so callers pass a written table.

    The label looks 12 months ahead, so the default rate of month t uses outcomes after
    t (as the reference computes it). ``lag_months=12`` attaches to month t the rate of
    month t - 12 instead, which only uses labels known by t."""
    keys = list(scope) + [zip_col]
    m = "_m"
    parts = (panel.groupBy(*keys, month)
             .agg(F.sum(F.col(target).cast("long")).alias("_s"), F.count(F.col(target)).alias("_n"))
             .withColumn(m, month_index(month)))
    w12, first = _frames(keys, m, strict_calendar)
    rate_month = F.col(month) if not lag_months else F.last_day(F.add_months(F.col(month), lag_months))
    rates = parts.select(
        *[F.col(k).alias("_r_" + k) for k in keys], rate_month.alias("_r_" + month),
        (_trailing(F.sum, F.col("_s"), w12, first, month).cast("double")
         / _trailing(F.sum, F.col("_n"), w12, first, month).cast("double")).alias(out))
    from ..session import scratch_path
    path = scratch_path(panel.sparkSession, "zip-rates")
    rates.write.parquet(path)
    rates = panel.sparkSession.read.parquet(path)
    cond = [panel[k].eqNullSafe(rates["_r_" + k]) for k in keys + [month]]
    return panel.join(rates, cond, "left").drop(*["_r_" + k for k in keys + [month]])


def loan_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Payment_Ratio": safe_div(F.col("UPB") - F.col("Current_Actual_UPB"), F.col("UPB")),
        "Balance_Per_Month": safe_div("Current_Actual_UPB", "Months_to_Maturity"),
        "Maturity_Progress": safe_div("Loan_Age", "Loan_Term"),
    })


def log_money(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Log_UPB": log10p1("UPB"),
        "Log_Curr_UPB": log10p1("Current_Actual_UPB"),
        "Log_Non_Int_Bear_UPB": log10p1("Current_Non_Int_UPB"),
    })


def signed_target(df: DataFrame, target: str = "Default") -> DataFrame:
    """0/1 label -> -1/+1 (null stays null)."""
    t = F.col(target)
    return df.withColumn(target, F.when(t == 0, F.lit(-1)).when(t == 1, F.lit(1)).otherwise(t))


def build_panel(orig: DataFrame, perf: DataFrame, key: str = LOAN,
                zip_scope=("Year", "Quarter"), strict_calendar: bool = True) -> DataFrame:
    """Cleaned origination + cleaned performance -> labelled panel with all features.

    Performance rows of loans absent from the origination table, and every row of a
    loan that ever carries the defect code, are dropped (as the reference does)."""
    labelled = label_and_lookback(perf, key=key, strict_calendar=strict_calendar)
    orig_cols = [c for c in orig.columns if c not in set(labelled.columns) or c == key]
    panel = labelled.join(orig.select(*orig_cols), key, "inner")
    panel = loan_ratios(log_money(panel))
    # the rate reads five columns of the panel and joins back to it: written once, the
    # performance rows are scanned, shuffled and windowed once
    from ..session import scratch_path
    spark = panel.sparkSession
    path = scratch_path(spark, "labelled-panel")
    panel.write.parquet(path)
    panel = spark.read.parquet(path)
    panel = zip_default_rate(panel, scope=zip_scope, strict_calendar=strict_calendar)
    return signed_target(panel)
