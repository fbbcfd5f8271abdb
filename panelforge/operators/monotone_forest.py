"""Random forest with monotone constraints, grown level by level from histograms.

Rows are binned once and written; a level of all trees is one pass over them (or a few, if the
histograms of all trees pass ``GROUP_BYTES``). A task sums whole numbers of rows by (tree, node,
feature, bin, class) over the features drawn for the node; the sums are shuffled by (tree, node)
and the task that adds up a node also finds its best split, so the driver only sees one small
row per node. Bootstrap weights are Poisson draws from a hash of the row's key and the tree, and
all sums are integers: a retried task, another partitioning or another order gives the same forest.

A feature with sign +1 (-1) may only split where the right side's share of defaults is not
below (above) the left one's. The middle of the two shares is passed down as a bound on both
subtrees, and a split whose sides leave the node's bounds is not made; so the forest's
probability never falls (rises) as that feature grows. A missing value (``missing``) is a bin
of its own below all others; the cut between it and the rest is free of the constraint.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

GROUP_BYTES = 64 << 20  # of histograms that a task holds at a time
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


class MonotoneForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector) and ``prediction`` to rows with columns f0.., f1... Trees are
    heaps: node i has the children 2i + 1 (value <= threshold) and 2i + 2; a leaf has feature -1."""
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    features = Param(Params._dummy(), "features", "feature of every node, -1 for none", TypeConverters.toListInt)
    thresholds = Param(Params._dummy(), "thresholds", "threshold of every node", TypeConverters.toListFloat)
    values = Param(Params._dummy(), "values", "share of class 1 of every node", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, trees=None, features=None, thresholds=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        shape = (self.getOrDefault("trees"), -1)
        feature = np.array(self.getOrDefault("features"), np.int64).reshape(shape)
        threshold = np.array(self.getOrDefault("thresholds")).reshape(shape)
        value = np.array(self.getOrDefault("values")).reshape(shape)
        used = np.unique(feature[feature >= 0])
        place = np.searchsorted(used, feature)  # of a leaf: not read
        if not len(used):
            p = F.lit(float(value[:, 0].mean()))
        else:
            @F.pandas_udf("double")
            def score(rows: pd.Series) -> pd.Series:
                x = np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, len(used)))
                at, total = np.arange(len(x)), np.zeros(len(x))
                for t in range(len(feature)):
                    node = np.zeros(len(x), np.int64)
                    while (inner := feature[t, node] >= 0).any():
                        right = ~(x[at[inner], place[t, node[inner]]] <= threshold[t, node[inner]])
                        node[inner] = 2 * node[inner] + 1 + right
                    total += value[t, node]
                return pd.Series(total / len(feature))

            p = score(F.array(*[F.col(f"f{i}").cast("double") for i in used]))
        out = df.withColumn("p__1", p)
        return out.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("p__1"), F.col("p__1")))).withColumn(
            "prediction", (F.col("p__1") > 0.5).cast("double")).drop("p__1")


@dataclass
class Binned:
    """The written table (key, bins, label), with the cut points of every feature."""
    table: DataFrame
    cuts: list
    counts: np.ndarray  # rows of class 0 and 1
    free: np.ndarray  # per feature: the cut between missing and the rest, -1 for none

    @property
    def width(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1


def _cut_points(table: DataFrame, p: int, max_bins: int, missing: float | None) -> list:
    """Ascending upper ends of the bins: every whole number of a feature with few of them,
    approximate quantiles (a mergeable sketch) of any other, and ``missing`` where it is lowest."""
    def run(batches):
        lo, hi, whole = np.full(p, np.inf), np.full(p, -np.inf), np.ones(p, bool)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            if len(x):
                lo, hi, whole = np.minimum(lo, x.min(0)), np.maximum(hi, x.max(0)), whole & (x == np.rint(x)).all(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), pa.array(lo), pa.array(hi), pa.array(whole)],
                                         names=["j", "lo", "hi", "whole"])

    ends = table.select("features").mapInArrow(run, "j long, lo double, hi double, whole boolean").groupBy("j").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("whole").alias("whole")).collect()
    cuts: list = [np.zeros(0)] * p
    rest: dict = {}
    for r in ends:
        if r.whole and r.hi - r.lo < max_bins:
            cuts[r.j] = np.arange(r.lo, r.hi) if r.hi > r.lo else np.zeros(0)
        else:
            rest[r.j] = [missing] if r.lo == missing else []
    if rest:
        at = [k / max_bins for k in range(1, max_bins)]
        row = table.agg(*[F.percentile_approx(F.col("features")[j], at, 10_000).alias(f"q{j}") for j in rest]).first()
        for j in rest:
            cuts[j] = np.unique(np.array(rest[j] + row[f"q{j}"], float))
    return cuts


def binned(spark: SparkSession, rows: DataFrame, n_features: int, key: Column, missing: float | None = -1.0,
           max_bins: int = 64) -> Binned:
    """Bins ``rows`` with columns f0.. and label (0 or 1). ``max_bins`` is at most 255."""
    if not 2 <= max_bins <= 255:
        raise ValueError(f"max_bins must be 2 to 255, not {max_bins}")
    p = n_features
    plain, path = scratch_path(spark, "forest-rows"), scratch_path(spark, "forest-bins")
    rows.select(F.array(*[F.col(f"f{i}").cast("double") for i in range(p)]).alias("features"), key.alias("key"),
                F.col("label").cast("int").alias("label")).write.parquet(plain)
    table = spark.read.parquet(plain)
    cuts = _cut_points(table, p, max_bins, missing)

    def run(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            b = np.empty(x.shape, np.uint8)
            for j in range(p):
                b[:, j] = np.searchsorted(cuts[j], x[:, j], side="left")
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([r.tobytes() for r in b], pa.binary()), batch.column(2)],
                                             names=["key", "bins", "label"])

    table.mapInArrow(run, "key long, bins binary, label int").write.parquet(path)
    table = spark.read.parquet(path)
    counts = np.zeros(2, np.int64)
    for r in table.groupBy("label").count().collect():
        counts[r.label] = r["count"]
    free = np.array([0 if missing is not None and len(c) and c[0] == missing else -1 for c in cuts])
    return Binned(table, cuts, counts, free)


def draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) bootstrap weights of the rows with these keys."""
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_POISSON, (x ^ (x >> np.uint64(31))) / 2.0 ** 64, side="right")


def _node_sums(data: Binned, wanted: dict, drawn: dict, feature: np.ndarray, cut: np.ndarray, seed: int | None) -> DataFrame:
    """(tree, node, sums) with whole sums by (drawn feature, bin, class), one row per node.
    ``wanted`` holds the open nodes of each tree, ``drawn`` the features of each (tree, node)."""
    p, width = len(data.cuts), data.width
    slots, picked = {}, {}
    for tree, nodes in wanted.items():
        slots[tree] = np.full(feature.shape[1], -1)
        slots[tree][nodes] = np.arange(len(nodes))
        picked[tree] = np.stack([drawn[tree, n] for n in nodes])

    def run(batches):
        held = {t: np.zeros(f.size * width * 2, np.int64) for t, f in picked.items()}
        for batch in batches:
            key, label = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, p)
            for t, f in picked.items():
                w = np.ones(len(key), np.int64) if seed is None else draws(key, t, seed)
                node = np.zeros(len(key), np.int64)
                while (inner := (feature[t, node] >= 0) & (slots[t][node] < 0)).any():
                    at = np.flatnonzero(inner)
                    node[at] = 2 * node[at] + 1 + (bins[at, feature[t, node[at]]] > cut[t, node[at]])
                at = np.flatnonzero((slots[t][node] >= 0) & (w > 0))
                slot, m = slots[t][node[at]], f.shape[1]
                cell = ((slot[:, None] * m + np.arange(m)) * width + bins[at[:, None], f[slot]]) * 2 + label[at][:, None]
                held[t] += np.bincount(cell.ravel(), np.repeat(w[at], m), held[t].size).astype(np.int64)
        for t, sums in held.items():
            sums = sums.reshape(len(wanted[t]), -1)
            some = np.flatnonzero(sums.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), t)), pa.array(np.array(wanted[t])[some]),
                 pa.array([sums[i].tobytes() for i in some], pa.binary())], names=["tree", "node", "sums"])

    def add(batches):
        total: dict = {}
        for batch in batches:
            for t, n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                x = np.frombuffer(raw.as_buffer(), np.int64)
                if (t, n) in total:
                    total[t, n] += x
                else:
                    total[t, n] = x.copy()
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total]), pa.array([k[1] for k in total]),
                 pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["tree", "node", "sums"])

    ddl = "tree long, node long, sums binary"
    return data.table.mapInArrow(run, ddl).repartition("tree", "node").mapInArrow(add, ddl)


def _split_scores(sums: np.ndarray, picked: np.ndarray, weights: np.ndarray, signs: np.ndarray, free: np.ndarray,
                  low: float, high: float):
    """Of sums (feature, bin, class): rows left and right of every cut, shares of class 1, gain in
    weighted Gini impurity, and whether signs and bounds allow the cut (both sides hold rows)."""
    left = sums.cumsum(1)[:, :-1]
    right = sums.sum(1)[:, None] - left
    lw, rw = left * weights, right * weights
    ln, rn = lw.sum(2), rw.sum(2)
    both = (left.sum(2) > 0) & (right.sum(2) > 0)
    pl, pr = lw[..., 1] / np.where(both, ln, 1), rw[..., 1] / np.where(both, rn, 1)
    p = (lw + rw)[..., 1] / (ln + rn)
    gain = 2 * ((ln + rn) * p * (1 - p) - ln * pl * (1 - pl) - rn * pr * (1 - pr)) / (ln + rn)
    bound = np.arange(left.shape[1])[None] != free[picked][:, None]
    allowed = ~bound | (signs[picked][:, None] * (pr - pl) >= 0)
    inside = (np.minimum(pl, pr) >= low) & (np.maximum(pl, pr) <= high)
    return left, right, pl, pr, gain, both, allowed & inside


def grow(data: Binned, signs: list, num_trees: int, max_depth: int, seed: int | None, drawn_features: int | None = None,
         balanced: bool = True) -> MonotoneForestModel:
    """The forest on ``data``. ``signs`` has +1, -1 or 0 per feature; ``seed`` None means no
    bootstrap; ``drawn_features`` per node, the square root of all by default."""
    p, size = len(data.cuts), 2 ** (max_depth + 1) - 1
    m = min(p, drawn_features or max(1, round(math.sqrt(p))))
    weights = data.counts.sum() / (2 * np.maximum(data.counts, 1)) if balanced else np.ones(2)
    signs, free = np.array(signs, float), data.free
    feature, cut = np.full((num_trees, size), -1), np.zeros((num_trees, size), np.int64)
    value = np.zeros((num_trees, size))
    value[:, 0] = (data.counts * weights)[1] / max((data.counts * weights).sum(), 1e-300)
    bounds = np.tile([0.0, 1.0], (num_trees, size, 1))
    open_ = {t: [0] for t in range(num_trees)} if p and data.counts.all() else {}
    for _ in range(max_depth):
        drawn = {(t, n): np.sort(np.random.default_rng((seed or 0, t, n)).choice(p, m, replace=False))
                 for t, nodes in open_.items() for n in nodes}
        found = []
        for group in _groups(open_, m * data.width * 16):
            nodes = _node_sums(data, group, drawn, feature, cut, seed)
            mine = {k: (drawn[k], *bounds[k]) for k in drawn if k[0] in group}

            def best(batches, mine=mine):
                out = []
                for batch in batches:
                    for t, n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                        picked, low, high = mine[t, n]
                        sums = np.frombuffer(raw.as_buffer(), np.int64).reshape(len(picked), -1, 2)
                        share = (sums[0].sum(0) * weights)[1] / (sums[0].sum(0) * weights).sum()
                        left, right, pl, pr, gain, both, ok = _split_scores(sums, picked, weights, signs, free, low, high)
                        gain = np.where(both & ok, gain, 0)
                        i, k = np.unravel_index(gain.argmax(), gain.shape) if gain.size else (0, 0)
                        split = gain.size and gain[i, k] > 1e-12
                        out.append((t, n, share, *((int(picked[i]), int(k), pl[i, k], pr[i, k]) if split else (-1, 0, 0.0, 0.0))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)],
                                                     names=["tree", "node", "share", "feature", "cut", "pl", "pr"])

            found += nodes.mapInArrow(best, "tree long, node long, share double, feature long, cut long, pl double, pr double").collect()
        open_ = {}
        for r in found:
            value[r.tree, r.node] = r.share
            if r.feature < 0:
                continue
            feature[r.tree, r.node], cut[r.tree, r.node] = r.feature, r.cut
            low, high = bounds[r.tree, r.node]
            sign = 0 if r.cut == free[r.feature] else signs[r.feature]
            mid = (r.pl + r.pr) / 2
            for child, share, end in ((2 * r.node + 1, r.pl, 1), (2 * r.node + 2, r.pr, -1)):
                value[r.tree, child] = share
                bounds[r.tree, child] = (low, mid) if sign * end > 0 else (mid, high) if sign * end < 0 else (low, high)
                open_.setdefault(r.tree, []).append(child)
    threshold = np.array([[data.cuts[f][c] if f >= 0 else 0.0 for f, c in zip(*tree)] for tree in zip(feature, cut)])
    return MonotoneForestModel(trees=num_trees, features=feature.ravel().tolist(), thresholds=threshold.ravel().tolist(),
                               values=value.ravel().tolist())


def _groups(open_: dict, node_bytes: int):
    group, held = {}, 0
    for t, nodes in open_.items():
        if group and held + len(nodes) * node_bytes > GROUP_BYTES:
            yield group
            group, held = {}, 0
        group[t] = sorted(nodes)
        held += len(nodes) * node_bytes
    if group:
        yield group


def root_splits(data: Binned, signs: list, balanced: bool = True) -> DataFrame:
    """Every cut of every feature over all rows: feature (position), at_most (largest value of the
    left side), p_left, p_right (shares of class 1), gain, allowed (by the feature's sign)."""
    p = len(data.cuts)
    every, none = np.arange(p), np.full((1, 1), -1)
    weights = data.counts.sum() / (2 * np.maximum(data.counts, 1)) if balanced else np.ones(2)
    signs, free, cuts = np.array(signs, float), data.free, data.cuts

    def run(batches):
        for batch in batches:
            for raw in batch.column(2):
                sums = np.frombuffer(raw.as_buffer(), np.int64).reshape(p, -1, 2)
                _, _, pl, pr, gain, both, ok = _split_scores(sums, every, weights, signs, free, 0.0, 1.0)
                i, k = np.nonzero(both)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i), pa.array([float(cuts[a][b]) for a, b in zip(i, k)], pa.float64()), pa.array(pl[i, k]),
                     pa.array(pr[i, k]), pa.array(gain[i, k]), pa.array(ok[i, k])],
                    names=["feature", "at_most", "p_left", "p_right", "gain", "allowed"])

    return _node_sums(data, {0: [0]}, {(0, 0): every}, none, none, None).mapInArrow(
        run, "feature long, at_most double, p_left double, p_right double, gain double, allowed boolean")
