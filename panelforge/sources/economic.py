"""Readers of the published economic series (header CSV, explicit schemas)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import HPI_SCHEMA, INCOME_SCHEMA, INFLATION_SCHEMA, RATE_SCHEMA, UNEMPLOYMENT_SCHEMA


def read_series_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header CSV with an explicit schema (no inference). Columns are matched by
    position; the header line is skipped."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_income(spark: SparkSession, path: str) -> DataFrame:
    """Median income file: unnamed index column, Month (YYYY-MM), State, Median_Ann_Income."""
    return read_series_csv(spark, path, INCOME_SCHEMA).select("Month", "State", "Median_Ann_Income")


def read_unemployment(spark: SparkSession, path: str) -> DataFrame:
    return read_series_csv(spark, path, UNEMPLOYMENT_SCHEMA)


def read_inflation(spark: SparkSession, path: str) -> DataFrame:
    return read_series_csv(spark, path, INFLATION_SCHEMA)


def read_house_price_index(spark: SparkSession, path: str) -> DataFrame:
    return read_series_csv(spark, path, HPI_SCHEMA)


def read_mortgage_rate(spark: SparkSession, path: str) -> DataFrame:
    return read_series_csv(spark, path, RATE_SCHEMA)
