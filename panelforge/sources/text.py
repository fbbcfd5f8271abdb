"""Headerless ``|``-separated loan files with enforced schemas (and the writer used
to produce such files from DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import ORIGINATION_SCHEMA, PERFORMANCE_SCHEMA


def scan_pipe_text(spark: SparkSession, path: str, schema, mode: str = "FAILFAST") -> DataFrame:
    """Splittable text scan: one task per file block, no schema inference. Empty fields
    are null. ``FAILFAST`` raises on rows that do not fit the schema."""
    return (spark.read.schema(schema).option("sep", "|").option("header", False)
            .option("mode", mode).csv(path))


def scan_origination(spark: SparkSession, path: str, **kw) -> DataFrame:
    return scan_pipe_text(spark, path, ORIGINATION_SCHEMA, **kw)


def scan_performance(spark: SparkSession, path: str, **kw) -> DataFrame:
    return scan_pipe_text(spark, path, PERFORMANCE_SCHEMA, **kw)


def write_pipe_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "|").option("header", False).csv(path)
