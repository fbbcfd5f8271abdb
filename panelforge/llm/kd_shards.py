"""K-d tree sharding by bytes, in DataFrame operations only.

A node that is to hold k shards is cut at the weighted quantile k//2 / k of its widest
metadata dimension, until every node is one shard. The dimensions share one scale: a
63-bit key, the value in the upper 31 bits (log bytes; hashed source, language, content), then 32 hash bits of
the row, so one value that a third of the rows share can still be cut anywhere. Quantiles
are found by weighted histograms: a few passes narrow the interval that holds the cut,
all nodes of a level together; the driver sees a few numbers per node.

Defined results: null text weighs ``overhead`` bytes; null metadata is a value of its own
(lowest); repeated rows are assigned each; an empty table gives no rows; other columns
are ignored."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, number_within, pick, utf8

BINS = 4096


def describe(docs: DataFrame, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, size, text_crc32, tie and a 63-bit key for each dimension: bytes (log scale),
    source, language, content (equal texts lie together)."""
    d = pick(docs, doc_id=id_col, text=text_col, source=source_col, lang=lang_col)
    tie = F.xxhash64("doc_id", "text")
    low = tie.bitwiseAND(F.lit((1 << 32) - 1))
    top = lambda value: F.shiftleft(value.cast("long"), 32).bitwiseOR(low)
    unit = lambda c: top(F.when(F.col(c).isNull(), F.lit(0)).otherwise(
        F.shiftrightunsigned(F.xxhash64(F.col(c)), 33)))
    n = F.octet_length(utf8(F.col("text")))
    return d.select(
        "doc_id", (n + F.lit(overhead)).cast("long").alias("size"), F.crc32(utf8(F.col("text"))).alias("text_crc32"),
        tie.alias("tie"), top(F.floor(F.log2(n + F.lit(1)) * F.lit(float(1 << 26)))).alias("bytes"),
        unit("source").alias("source"), unit("lang").alias("lang"), unit("text").alias("content"))


DIMENSIONS = ["bytes", "source", "lang", "content"]


class _Node:
    def __init__(self, shards: int, first: int):
        self.shards, self.first = shards, first
        self.dim = self.cut = self.low = self.high = None


def _leaf(node: _Node) -> Column:
    """The first shard of the current node of a row, as one nested expression."""
    if node.cut is None:
        return F.lit(node.first)
    return F.when(F.col(node.dim) <= F.lit(node.cut), _leaf(node.low)).otherwise(_leaf(node.high))


def _cut(rows: DataFrame, nodes: list[_Node]) -> None:
    """Sets ``cut`` of every node: the largest key so that the rows up to it weigh no more
    than the node's share, within one row."""
    by = {n.first: n for n in nodes}
    key = F.lit(None).cast("long")
    for n in nodes:
        key = F.when(F.col("node") == n.first, F.col(n.dim)).otherwise(key)
    rows = rows.select("node", "size", key.alias("k"))
    state = {r["node"]: {"lo": r["lo"], "hi": r["hi"], "below": 0, "want": r["w"] * (by[r["node"]].shards // 2) /
                         by[r["node"]].shards, "cut": r["lo"] - 1}
             for r in rows.groupBy("node").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.sum("size").alias("w"))
             .collect()}
    todo = dict(state)
    while todo:
        width, low, high = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long")
        for n, s in todo.items():
            here = F.col("node") == n
            width = F.when(here, F.lit((s["hi"] - s["lo"]) // BINS + 1)).otherwise(width)
            low, high = F.when(here, F.lit(s["lo"])).otherwise(low), F.when(here, F.lit(s["hi"])).otherwise(high)
        inside = rows.withColumn("lo", low).where((F.col("k") >= F.col("lo")) & (F.col("k") <= high))
        bins = (inside.withColumn("w", width).groupBy("node", F.expr("(k - lo) div w").alias("bin"))
                .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("k").alias("first"),
                     F.max("k").alias("last")))
        per: dict[int, list] = {}
        for r in bins.collect():  # at most BINS rows for each node of the level
            per.setdefault(r["node"], []).append(r)
        for n, s in list(todo.items()):
            del todo[n]
            for r in sorted(per.get(n, []), key=lambda r: r["bin"]):
                if s["below"] + r["bytes"] <= s["want"]:
                    s["below"], s["cut"] = s["below"] + r["bytes"], r["last"]
                    continue
                if r["first"] < r["last"]:
                    s["lo"], s["hi"], todo[n] = r["first"], r["last"], s
                elif s["below"] + r["bytes"] - s["want"] < s["want"] - s["below"]:
                    s["cut"] = r["last"]  # one key: over by less than what is missing without it
                break
    for n in nodes:
        n.cut = state[n.first]["cut"] if n.first in state else 0


def kd_shards(spark: SparkSession, docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              overhead: int = 8, buckets: int = 64, **columns: str) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless in the shard). Give the number of
    shards or the bytes a shard should have."""
    rows = materialize(spark, describe(docs, overhead, **columns), "kd-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    root = _Node(shards, 0)
    level = [root] if shards > 1 and total else []
    while level:
        placed = rows.withColumn("node", _leaf(root)).where(F.col("node").isin([n.first for n in level]))
        spread = {r["node"]: r for r in placed.groupBy("node").agg(
            *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()}
        for n in level:  # all keys have one scale; a span within one value's hash bits counts as none
            n.dim = max(DIMENSIONS, key=lambda d: spread[n.first][d] >> 32) if n.first in spread else DIMENSIONS[0]
        _cut(placed, level)
        for n in level:
            n.low, n.high = _Node(n.shards // 2, n.first), _Node(n.shards - n.shards // 2, n.first + n.shards // 2)
        level = [c for n in level for c in (n.low, n.high) if c.shards > 1]
    placed = rows.select("doc_id", "size", "text_crc32", "tie", _leaf(root).cast("int").alias("shard"))
    return number_within(placed, "shard", ["tie", "doc_id", "text_crc32"], "slot", buckets).drop("tie")
