"""Quarter lists: expansion of a (start, end) range, the quarters present in a table
and the wanted quarters that have no data yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quarters_list(mode: str, start=None, end=None, listed=None) -> list:
    """Driver-side configuration: ``start_end`` expands an inclusive (year, quarter)
    range, ``list`` takes the given quarters. Anything else is an error."""
    if mode == "list":
        return [tuple(x) for x in listed]
    if mode != "start_end":
        raise ValueError(f"unknown quarter mode {mode!r}: use start_end or list")
    index = [4 * year + quarter - 1 for year, quarter in (start, end)]
    return [(i // 4, i % 4 + 1) for i in range(index[0], index[1] + 1)]


def _spine(bounds: DataFrame) -> DataFrame:
    d = F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 3 MONTH"))).alias("_d")
    return bounds.select(d).select(F.year("_d").alias("Year"), F.quarter("_d").alias("Quarter"))


def quarter_spine(spark: SparkSession, start, end) -> DataFrame:
    """(Year, Quarter) rows from ``start`` to ``end`` inclusive."""
    (sy, sq), (ey, eq) = start, end
    b = spark.range(1).select(F.make_date(F.lit(sy), F.lit(sq * 3 - 2), F.lit(1)).alias("_lo"),
                              F.make_date(F.lit(ey), F.lit(eq * 3 - 2), F.lit(1)).alias("_hi"))
    return _spine(b)


def spine_from_months(df: DataFrame, month: str = "Month") -> DataFrame:
    """Every quarter between the first and the last month of a table (one aggregate)."""
    b = df.agg(F.trunc(F.min(month), "quarter").alias("_lo"), F.trunc(F.max(month), "quarter").alias("_hi"))
    return _spine(b)


def present_quarters(df: DataFrame, year: str = "Year", quarter: str = "Quarter") -> DataFrame:
    return df.select(F.col(year).alias("Year"), F.col(quarter).alias("Quarter")).distinct()


def missing_quarters(wanted: DataFrame, table: DataFrame) -> DataFrame:
    """Wanted quarters without any row in ``table`` (anti join on Year, Quarter)."""
    return wanted.join(present_quarters(table), ["Year", "Quarter"], "left_anti")
