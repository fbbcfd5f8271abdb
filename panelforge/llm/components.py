"""Connected components by alternating large-star and small-star steps.

Each step is a partially aggregated minimum per node and a join (which AQE can split for
a node with very many links); no component is ever gathered in one task. Every round is
written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    up = e.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return up.union(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of long ids -> (id, component): for every id on an edge the smallest
    id reachable. Rows with a null or with a = b are ignored; repeated and reversed edges
    are allowed; no edges give an empty table."""
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(spark, e, "cc-edges")
    while True:
        e = materialize(spark, _small_star(_large_star(e)), "cc-round")
        # done when the edges are stars: no lower end is an upper end, one edge per upper end
        heads = e.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        bad = heads.where("n > 1").select("a").union(e.join(heads.select(F.col("a").alias("b")), "b", "left_semi")
                                                     .select("a"))
        if bad.isEmpty():
            break
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
