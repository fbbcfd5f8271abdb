"""Economic series: cleaning, monthly gap fill, release-calendar lags and enrichment.

Each series is keyed by month (and a state or 3-digit ZIP code), so its size is
bounded by (#keys x #months), independent of the loan data. Joins against the
loan panel carry no hint: the planner and AQE broadcast by measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (is_monthly_period, log10p1, month_end, period_to_month, quarter_end,
                         release_lag, safe_div, zero_pad)



def gap_fill(df: DataFrame, keys: list, month: str = "Month") -> DataFrame:
    """Monthly grid per key from its first to its last month-end, then forward fill of
    every value column (also nulls inside the original rows)."""
    values = [c for c in df.columns if c not in set(keys) | {month}]
    bounds = df.groupBy(*keys).agg(F.min(month).alias("_lo"), F.max(month).alias("_hi"))
    grid = bounds.select(*keys, F.explode(F.sequence(F.trunc("_lo", "month"), F.trunc("_hi", "month"),
                                                    F.expr("INTERVAL 1 MONTH"))).alias("_d"))
    grid = grid.select(*keys, F.last_day("_d").alias(month))
    # join on the keys plus the month-end; keys of a series are never null
    snapped = df.withColumn(month, F.last_day(month))
    j = grid.join(snapped, keys + [month], "left")
    w = Window.partitionBy(*keys).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(*keys, month, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in values])


def last_of_month(df: DataFrame, date: str = "Date", value: str = "US_30yr_FRM",
                  month: str = "Month") -> DataFrame:
    """Weekly/daily -> monthly: the value of the latest date in each month."""
    return (df.groupBy(F.last_day(date).alias(month))
            .agg(F.max_by(value, date).alias(value)))


def income(raw: DataFrame) -> DataFrame:
    base = raw.select(month_end("Month", "yyyy-MM").alias("Month"), "State", "Median_Ann_Income")
    return gap_fill(base, ["State"])


def unemployment(raw: DataFrame) -> DataFrame:
    return raw.select(month_end("Month", "yyyy-MM").alias("Month"),
                      zero_pad("zip", 3).alias("ZIP_Code"),
                      F.col("unemp_rate").alias("Unemp_Rate"))


def inflation(raw: DataFrame) -> DataFrame:
    """Monthly CPI change; half-year (S01/S02) and other non-monthly periods are dropped."""
    return (raw.where(is_monthly_period("Period"))
            .select(period_to_month("Year", "Period").alias("Month"), F.col("Value").alias("Infl_Rate")))


def house_price_index(raw: DataFrame) -> DataFrame:
    base = raw.select(quarter_end("Year", "Quarter").alias("Month"),
                      zero_pad(F.col("`ZIP Code`"), 3).alias("ZIP_Code"),
                      F.col("Index").alias("HP_Index"))
    return gap_fill(base, ["ZIP_Code"])


def mortgage_rate(raw: DataFrame) -> DataFrame:
    return last_of_month(raw, "Date", "US_30yr_FRM").select("Month", "US_30yr_FRM")


def lagged(series: DataFrame, months: int, month: str = "Month") -> DataFrame:
    """Series as available ``months`` after its reference month (publication lag)."""
    return series.withColumn(month, release_lag(month, months))


def attach(left: DataFrame, right: DataFrame, left_on: list, right_on: list) -> DataFrame:
    """Left join of a keyed series. Right-side key columns are dropped. No hint: the planner
    and AQE broadcast the series by its measured bytes, or shuffle it."""
    r = right
    renamed = {}
    for lk, rk in zip(left_on, right_on):
        tmp = f"_k_{lk}"
        renamed[rk] = tmp
        r = r.withColumnRenamed(rk, tmp)
    cond = [left[lk] == r[renamed[rk]] for lk, rk in zip(left_on, right_on)]
    return left.join(r, cond, "left").drop(*renamed.values())


def suffixed(df: DataFrame, keys: list, suffix: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(c + suffix) for c in df.columns if c not in keys])


def enrich(loans: DataFrame, series: dict, rate_col: str = "Int_Rate") -> DataFrame:
    """All economic joins with their release lags, then the derived features.

    ``series`` holds the cleaned series: income, unemployment, inflation, hpi, rate.
    Lags: unemployment and inflation +1 month, house prices +2 (and +14 for the value a
    year earlier), income and the mortgage rate none.
    """
    inc, une, inf = series["income"], series["unemployment"], series["inflation"]
    hpi, rate = series["hpi"], series["rate"]
    hpi2 = lagged(hpi, 2)
    df = attach(loans, inc, ["Month", "Property_State"], ["Month", "State"])
    df = attach(df, lagged(une, 1), ["Month", "ZIP_Code"], ["Month", "ZIP_Code"])
    df = attach(df, lagged(inf, 1), ["Month"], ["Month"])
    df = attach(df, hpi2, ["Month", "ZIP_Code"], ["Month", "ZIP_Code"])
    df = attach(df, suffixed(hpi2, ["Month", "ZIP_Code"], "_Orig"),
                ["First_Payment_Month", "ZIP_Code"], ["Month", "ZIP_Code"])
    df = attach(df, suffixed(lagged(hpi, 14), ["Month", "ZIP_Code"], "_year"),
                ["Month", "ZIP_Code"], ["Month", "ZIP_Code"])
    df = attach(df, rate, ["Month"], ["Month"])
    df = attach(df, suffixed(rate, ["Month"], "_Orig"), ["First_Payment_Month"], ["Month"])
    return econ_features(df, rate_col=rate_col)


def econ_features(df: DataFrame, rate_col: str = "Int_Rate") -> DataFrame:
    """House-price changes, log income and rate spreads. The current spread uses the
    origination rate by default, as the reference does; pass ``Current_Int_Rate`` to change."""
    return df.withColumns({
        "HPI_Change_Orig": safe_div("HP_Index", "HP_Index_Orig") - F.lit(1.0),
        "HPI_Change_yoy": safe_div("HP_Index", "HP_Index_year") - F.lit(1.0),
        "Log_Median_Ann_Income": log10p1("Median_Ann_Income"),
        "Int_Rate_Diff": F.col("Int_Rate") - F.col("US_30yr_FRM_Orig"),
        "Curr_Int_Rate_Diff": F.col(rate_col) - F.col("US_30yr_FRM"),
    })


def clean_series(raw: dict) -> dict:
    return {"income": income(raw["income"]), "unemployment": unemployment(raw["unemployment"]),
            "inflation": inflation(raw["inflation"]), "hpi": house_price_index(raw["hpi"]),
            "rate": mortgage_rate(raw["rate"])}
