"""Loan-shaped inputs derived from the benchmark tables.

The benchmark tables hold no loans, so raw origination / performance records and
the five economic series are derived from ``part``, ``lineitem`` and ``orders``
with plain DataFrame aggregations; the result has exactly the raw layouts the
pipeline reads (``schemas.py``), so every operator runs unchanged on it. The same
derivation is written as SQL in ``fixtures_sql.py`` for the DuckDB oracle.

perf  : one row per (l_partkey, ship month)   -> loan id, month, balance, status, codes
orig  : one row per part                       -> loan attributes incl. sentinels
income / unemployment / inflation / HPI / rate : order aggregates by month, priority,
        customer bucket (``o_custkey % 25`` stands for a 3-digit ZIP code)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import ORIGINATION_SCHEMA, PERFORMANCE_SCHEMA

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(key: Column, values: list) -> Column:
    """values[key] for key in 0..len-1 as a CASE expression."""
    e = None
    for i, v in enumerate(values):
        e = F.when(key == i, F.lit(v)) if e is None else e.when(key == i, F.lit(v))
    return e


def _dec_sum(c) -> Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def _conform(df: DataFrame, schema) -> DataFrame:
    """Order and type columns as the raw file layout; absent columns become typed nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def raw_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by loan as narrow lines: the panel's windows over a loan need no second shuffle
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("Loan_Num"), "l_partkey",
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("_ym"), "l_extendedprice", "l_returnflag",
        "l_linenumber", "l_quantity", "l_tax", "l_discount").repartition("Loan_Num")
    g = (li.groupBy("Loan_Num", "l_partkey", F.col("_ym").cast("string").alias("Month"))
         .agg(_dec_sum("l_extendedprice").alias("Current_Actual_UPB"),
              F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("_r"),
              F.min("l_linenumber").alias("_mnl"), F.max("l_linenumber").alias("_mxl"),
              F.min("l_quantity").alias("_mnq"), F.max("l_quantity").alias("_mxq"),
              F.max("l_tax").alias("_mxt"), F.min("l_tax").alias("_mnt"),
              F.max("l_discount").alias("_mxd"), F.min("l_discount").alias("_mnd"),
              F.count(F.lit(1)).alias("_n"),
              _dec_sum("l_quantity").alias("Current_Non_Int_UPB")))
    r, mnl = F.col("_r"), F.col("_mnl")
    status = (F.when(r >= 3, "RA")
              .when(r == 2, F.when(mnl == 1, "12").otherwise("3"))
              .when(r == 1, F.when(mnl <= 3, "1").otherwise("2"))
              .otherwise("0"))
    zbc = (F.when((F.col("l_partkey") % 97 == 0) & (F.col("_mnq") <= 2), "96")
           .when(F.col("_mnq") >= 49, "03").when(F.col("_mnq") >= 48, "01"))
    out = g.select(
        "Loan_Num", "Month", "Current_Actual_UPB",
        status.alias("Current_Delinquency_Status"),
        F.col("_mxl").cast("int").alias("Loan_Age"),
        (F.col("_n") - 1).cast("int").alias("Months_to_Maturity"),
        F.when(F.col("_mxt") >= 0.08, "Y").alias("Modification_Flag"),
        zbc.alias("Zero_Balance_Code"),
        (F.col("_mxt") * 100.0).alias("Current_Int_Rate"),
        "Current_Non_Int_UPB",
        F.when(F.col("_mxq") >= 50, "Y").when(F.col("_mxq") >= 45, "N").alias("Step_Modification_Flag"),
        F.when(F.col("_mnt") == 0, "Y").otherwise("N").alias("Payment_Deferral_Flag"),
        F.when(F.col("_mxd") >= 0.1, 999.0).otherwise(F.col("_mxd") * 1000.0).alias("ELTV"),
        F.when(F.col("_mnd") == 0, "Y").alias("Delinquency_Disaster_Flag"),
        F.when(F.col("_mxl") == 7, "F").when(F.col("_mxl") == 6, "R").when(F.col("_mxl") == 5, "T")
        .alias("Borrower_Assistance_Status_Code"),
    )
    return _conform(out, PERFORMANCE_SCHEMA)


def raw_origination(spark: SparkSession, sf_dir: str, with_vintage: bool = True) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    out = p.select(
        F.when(s == 50, 9999).otherwise(s * 6 + 500).alias("Credit_Score"),
        F.concat(F.lit("1996"), F.lpad((k % 12 + 1).cast("string"), 2, "0")).alias("First_Payment_Month"),
        _pick(k % 3, ["Y", "N", "9"]).alias("First_Time_Home_Buyer_Flag"),
        F.lit("202612").alias("Maturity_Date"),
        F.when(s % 7 == 0, 999.0).otherwise((s % 40).cast("double")).alias("MI_Percentage"),
        F.when(k % 50 == 0, 99).otherwise(k % 3 + 1).alias("Num_Units"),
        _pick(k % 4, ["P", "I", "S", "9"]).alias("Occupancy_Status"),
        F.when(s % 10 == 0, 999.0).otherwise((s + 45).cast("double")).alias("CLTV"),
        F.when(s % 13 == 0, 999.0).otherwise((s % 45 + 10).cast("double")).alias("DTI"),
        (F.col("p_retailprice") * 1000.0).alias("UPB"),
        F.when(s % 10 == 0, 999.0).otherwise((s + 40).cast("double")).alias("LTV"),
        (s.cast("double") / 20.0 + 2.5).alias("Int_Rate"),
        _pick(k % 5, ["R", "C", "B", "T", "9"]).alias("Channel"),
        F.when(s % 2 == 0, "Y").otherwise("N").alias("Prepay_Penalty"),
        F.when(k % 6 == 0, "C").otherwise("R").alias("Amortization_Type"),
        _pick(k % 5, PRIORITIES).alias("Property_State"),
        _pick(k % 6, ["CO", "MH", "SF", "PU", "CP", "99"]).alias("Property_Type"),
        F.when(k % 25 == 0, "00").otherwise(F.concat(F.lpad((k % 25).cast("string"), 3, "0"), F.lit("00")))
        .alias("ZIP_Code"),
        k.cast("string").alias("Loan_Num"),
        _pick(k % 5, ["P", "C", "N", "R", "9"]).alias("Loan_Purpose"),
        (F.lit(360) - (k % 3) * 120).alias("Loan_Term"),
        F.when(s == 1, 99).otherwise(s % 2 + 1).alias("Num_Borrowers"),
        F.col("p_brand").alias("Seller_Name"), F.col("p_brand").alias("Servicer_Name"),
        F.when(s > 45, "Y").alias("Sup_Conforming_Flag"),
        F.when(s % 9 == 0, "9").otherwise("H").alias("Program_Indicator"),
        F.when(s % 3 == 0, "Y").alias("Ref_Indicator"),
        F.when(k % 11 == 0, "9").otherwise((k % 5).cast("string")).alias("Property_Val_Meth"),
        F.when(k % 7 == 0, "Y").otherwise("N").alias("Int_Only_Indicator"),
        _pick(k % 3, ["7", "9", "N"]).alias("MI_Canc_Indicator"),
    )
    raw = _conform(out, ORIGINATION_SCHEMA)
    if not with_vintage:
        return raw
    # vintage (origination year and quarter): the partition of the processed table
    return raw.withColumns({"Year": F.lit(2015),
                            "Quarter": (F.col("Loan_Num").cast("long") % 4 + 1).cast("int")})


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _dec_mean(c) -> Column:
    return _dec_sum(c) / F.count(F.lit(1)).cast("double")


def raw_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly (May) 'median income' per state: mean order total per priority in May."""
    o = _orders(spark, sf_dir).where(F.month("o_orderdate") == 5)
    return (o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("Month"),
                      F.col("o_orderpriority").alias("State"))
            .agg(_dec_mean("o_totalprice").alias("Median_Ann_Income"))
            .select(F.lit(0).cast("long").alias("_idx"), "Month", "State", "Median_Ann_Income"))


def raw_unemployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return (o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("Month"),
                      (F.col("o_custkey") % 25).alias("zip"))
            .agg((F.count(F.lit(1)).cast("double") / 10.0).alias("unemp_rate")))


def raw_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rows (Period ``Mnn``) plus half-year rows (``S01``/``S02``) to be dropped."""
    o = _orders(spark, sf_dir).select(F.year("o_orderdate").cast("long").alias("Year"),
                                      F.month("o_orderdate").alias("_mo"))
    monthly = (o.groupBy("Year", "_mo").agg((F.count(F.lit(1)).cast("double") / 100.0).alias("Value"))
               .select("Year", F.concat(F.lit("M"), F.lpad(F.col("_mo").cast("string"), 2, "0")).alias("Period"),
                       "Value"))
    half = (o.groupBy("Year", F.when(F.col("_mo") <= 6, "S01").otherwise("S02").alias("Period"))
            .agg((F.count(F.lit(1)).cast("double") / 600.0).alias("Value")))
    return monthly.unionByName(half)


def raw_house_price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return (o.groupBy((F.col("o_custkey") % 25).alias("ZIP Code"),
                      F.year("o_orderdate").cast("long").alias("Year"),
                      F.quarter("o_orderdate").cast("long").alias("Quarter"))
            .agg(_dec_mean("o_totalprice").alias("Index")))


def raw_mortgage_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series (stands for the weekly one): mean order total per day / 50000."""
    o = _orders(spark, sf_dir)
    return (o.groupBy(F.to_date("o_orderdate").alias("Date"))
            .agg((_dec_mean("o_totalprice") / 50000.0).alias("US_30yr_FRM")))


def economic_raw(spark: SparkSession, sf_dir: str) -> dict:
    return {"income": raw_income(spark, sf_dir), "unemployment": raw_unemployment(spark, sf_dir),
            "inflation": raw_inflation(spark, sf_dir), "hpi": raw_house_price_index(spark, sf_dir),
            "rate": raw_mortgage_rate(spark, sf_dir)}
