"""Logistic regression with a penalty per non-zero coefficient (L0), as a path of penalties.

Objective: mean log-loss + penalty * (number of features used) + ridge / 2 * |coefficients|^2,
with a free intercept; the ridge is tiny and only keeps separable data finite.

The rows are only ever read by one kind of job: for a list of points (support, coefficients) it
sums loss, gradient and weighted Gram matrix, in one pass and with a tree of partial sums.
Everything else works on those matrices, whose size is that of the features. From the model at
hand (the *anchor*) the quadratic expansion of the loss prices every addition, removal and swap
of one feature in closed form; the most promising moves are then fitted together by Newton
steps, and the path moves to the best of them by the true objective, as long as it falls. Fitted
supports are remembered, so a smaller penalty that changes nothing costs no job, and the path is
walked again from the top with all of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


class SparseLogisticModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scores the columns f<i> of its non-zero coefficients: one sum of products, no vector of
    all features. Adds ``probability`` (vector) and ``prediction``."""
    positions = Param(Params._dummy(), "positions", "feature positions in use", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "their coefficients", TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "intercept", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, positions=None, weights=None, bias=None, size=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def coefficients(self) -> SparseVector:
        return SparseVector(self.getOrDefault("size"), self.getOrDefault("positions"), self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("bias")

    def _transform(self, df: DataFrame) -> DataFrame:
        eta = F.lit(self.getOrDefault("bias"))
        for i, w in zip(self.getOrDefault("positions"), self.getOrDefault("weights")):
            eta = eta + F.lit(w) * F.col(f"f{i}")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p))).withColumn(
            "prediction", (p > 0.5).cast("double"))


@dataclass
class Step:
    """The model of one penalty of the path; ``support`` holds feature positions."""
    penalty: float
    support: tuple
    coefficients: np.ndarray
    intercept: float
    loss: float
    objective: float


class Sums:
    """Loss, gradient and Gram sums over a written table of (features, label)."""

    def __init__(self, table: DataFrame, n_features: int, fan_in: int = 32):
        self.table, self.p, self.fan_in, self.jobs = table, n_features, fan_in, 0
        self.parts = table.select(F.spark_partition_id().alias("p")).distinct().count()
        self.rows = table.count()

    def __call__(self, points: list, full: bool = False) -> list:
        """For every (support, coefficients with the intercept first): mean loss, gradient and
        Gram matrix, over intercept and support, or over everything if ``full``."""
        p = self.p
        points = [(np.array((0, *(j + 1 for j in s)), int), np.asarray(b, float)) for s, b in points]
        widths = [p + 1 if full else len(at) for at, _ in points]
        sizes = [1 + w + w * w for w in widths]

        def run(batches):
            total, any_ = np.zeros(sum(sizes)), False
            for batch in batches:
                if not batch.num_rows:
                    continue
                any_ = True
                x = np.ones((batch.num_rows, p + 1))
                x[:, 1:] = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
                y, at_ = batch.column(1).to_numpy(), 0
                for (at, beta), w, size in zip(points, widths, sizes):
                    xs = x[:, at]
                    eta = xs @ beta
                    mu = 0.5 * (1 + np.tanh(eta / 2))
                    xs = x if full else xs
                    total[at_] += (np.logaddexp(0, eta) - y * eta).sum()
                    total[at_ + 1: at_ + 1 + w] += xs.T @ (mu - y)
                    total[at_ + 1 + w: at_ + size] += ((xs * (mu * (1 - mu))[:, None]).T @ xs).ravel()
                    at_ += size
            if any_:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        def add(batches):
            total = 0
            for batch in batches:
                for raw in batch.column(0):
                    total = total + np.frombuffer(raw.as_buffer())
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        partial, parts = self.table.mapInArrow(run, "sums binary"), self.parts
        while parts > self.fan_in:  # a tree: no task and not the driver adds up all partitions
            parts = -(-parts // self.fan_in)
            partial = partial.repartition(parts).mapInArrow(add, "sums binary")
        self.jobs += 1
        total = np.sum([np.frombuffer(bytes(r.sums)) for r in partial.collect()], axis=0) / self.rows
        out, at_ = [], 0
        for w, size in zip(widths, sizes):
            out.append((total[at_], total[at_ + 1: at_ + 1 + w].copy(), total[at_ + 1 + w: at_ + size].reshape(w, w)))
            at_ += size
        return out


@dataclass
class _Fit:
    support: tuple
    beta: np.ndarray
    loss: float  # with the ridge term


def _newton(sums: Sums, starts: dict, ridge: float, rounds: int = 25, tol: float = 1e-6) -> list[_Fit]:
    """Fits of ``starts`` (support -> coefficients), all supports stepping in the same jobs."""
    at = {s: np.asarray(b, float) for s, b in starts.items()}
    last: dict = {}
    done: dict = {}
    for _ in range(rounds):
        if not at:
            break
        got = sums([(s, b) for s, b in at.items()])
        for (s, b), (loss, g, h) in zip(list(at.items()), got):
            held = np.r_[0.0, np.full(len(s), ridge)]
            loss, g, h = loss + 0.5 * (held * b * b).sum(), g + held * b, h + np.diag(held)
            if s in last and loss > last[s][1] + 1e-12:  # too far: half the way back
                at[s] = (b + last[s][0]) / 2
                if np.abs(at[s] - last[s][0]).max() < 1e-9:
                    done[s] = _Fit(s, *last[s])
                    del at[s]
                continue
            step = np.linalg.lstsq(h, g, rcond=1e-12)[0]
            last[s] = (b, loss)
            if g @ step < tol:
                done[s] = _Fit(s, b - step, loss - g @ step / 2)
                del at[s]
            else:
                at[s] = b - step
    return list(done.values()) + [_Fit(s, *last[s]) for s in at]


def _moves(fit: _Fit, g: np.ndarray, h: np.ndarray, most: int, per_kind: int):
    """Promising (support, start) by the quadratic expansion at ``fit``: for each kind of move
    (add, drop, swap) the best ``per_kind`` by their loss, with the minimiser as start."""
    at = np.array((0, *(j + 1 for j in fit.support)), int)
    inside = np.zeros(len(g), bool)
    inside[at] = True
    inv = np.linalg.pinv(h[np.ix_(at, at)], hermitian=True)
    diag = np.diag(h)

    def additions(at, inv, r):
        left = diag - (h[at] * (inv @ h[at])).sum(0)
        ok = (left > 1e-9 * np.maximum(diag, 1e-300)) & ~inside
        return np.where(ok, r * r / (2 * np.where(ok, left, 1)), 0)

    found = []  # (loss relative to the fit, kind, support)
    gains = additions(at, inv, -g)
    if len(fit.support) < most:
        for j in np.argsort(-gains)[:per_kind]:
            if gains[j] > 0:
                found.append((-gains[j], "add", tuple(sorted((*fit.support, int(j) - 1)))))
    swaps = []
    for k in range(1, len(at)):
        cost = fit.beta[k] ** 2 / (2 * max(inv[k, k], 1e-300))
        rest = tuple(j for j in fit.support if j + 1 != at[k])
        found.append((cost, "drop", rest))
        keep = np.delete(np.arange(len(at)), k)
        less = (inv - np.outer(inv[:, k], inv[k]) / max(inv[k, k], 1e-300))[np.ix_(keep, keep)]
        moved = -inv[:, k] * fit.beta[k] / max(inv[k, k], 1e-300)  # change of the coefficients
        r = -(g + h[:, at] @ moved)
        gain = additions(at[keep], less, r)
        for j in np.argsort(-gain)[:per_kind]:
            if gain[j] > 0:
                swaps.append((cost - gain[j], "swap", tuple(sorted((*rest, int(j) - 1)))))
    out = {}
    for kind, rows in (("add", found), ("drop", found), ("swap", swaps)):
        for _, _, support in sorted(r for r in rows if r[1] == kind)[:per_kind]:
            new = np.array((0, *(j + 1 for j in support)), int)
            old = np.zeros(len(g))
            old[at] = fit.beta
            # minimum of the expansion on the new support
            b = h[new] @ old - g[new]
            out[support] = np.linalg.lstsq(h[np.ix_(new, new)], b, rcond=1e-12)[0]
    return out


def _written(spark: SparkSession, rows: DataFrame, n_features: int) -> Sums:
    path = scratch_path(spark, "l0-rows")
    rows.select(F.array(*[F.col(f"f{i}").cast("double") for i in range(n_features)]).alias("features"),
                F.col("label").cast("double").alias("label")).write.parquet(path)
    return Sums(spark.read.parquet(path), n_features)


def screen(spark: SparkSession, rows: DataFrame, n_features: int) -> list[float]:
    """Mean log-loss of every feature's own logistic model (with intercept), all fitted in the
    same few jobs."""
    fits = _newton(_written(spark, rows, n_features), {(j,): np.zeros(2) for j in range(n_features)}, 0.0, tol=1e-10)
    return [f.loss for f in sorted(fits, key=lambda f: f.support)]


def l0_path(spark: SparkSession, rows: DataFrame, n_features: int, max_support: int = 40, num_lambda: int = 150,
            scale_down: float = 0.8, ridge: float = 1e-6, per_kind: int = 8, tol: float = 1e-9) -> tuple[list[Step], Sums]:
    """The path over ``lambda_max * scale_down ** i``, i < num_lambda, on ``rows`` with columns
    f0.. and label; ends after the first model with more than ``max_support`` features, which is
    left out. ``lambda_max`` is what the best first feature is worth."""
    sums = _written(spark, rows, n_features)
    (now,) = _newton(sums, {(): np.zeros(1)}, ridge)
    fits = {(): now}
    models: dict = {}

    def moves_of(fit: _Fit) -> list[_Fit]:
        """Fits of the promising moves from ``fit`` (remembered)."""
        if fit.support not in models:
            ((_, g, h),) = sums([(fit.support, fit.beta)], full=True)
            held = np.zeros(n_features + 1)
            held[1:] = ridge
            at = [0, *(j + 1 for j in fit.support)]
            g[at] += held[at] * fit.beta
            starts = _moves(fit, g, h + np.diag(held), max_support + 1, per_kind)
            for new in _newton(sums, {s: b for s, b in starts.items() if s not in fits}, ridge):
                fits[new.support] = new
            models[fit.support] = [fits[s] for s in starts]
        return models[fit.support]

    def improved(now: _Fit, penalty: float) -> _Fit:
        """On to the best move, or to the best support met so far, while the objective falls."""
        def worth(f: _Fit) -> float:
            return f.loss + penalty * len(f.support)

        while True:
            best = min([*moves_of(now), *fits.values()], key=worth)
            if worth(best) >= worth(now) - tol:
                return now
            now = best

    found: list[tuple[float, _Fit]] = []
    penalty = max([now.loss - f.loss for f in moves_of(now)] + [0.0]) or 1e-12
    for _ in range(num_lambda):
        now = improved(now, penalty)
        if len(now.support) > max_support:
            break
        found.append((penalty, now))
        if now.loss < 1e-7:
            break
        penalty *= scale_down
    # supports met at smaller penalties may also serve the greater ones: features that help only
    # together are found there first
    steps = [(q, improved(f, q)) for q, f in found]
    return [Step(q, f.support, f.beta[1:], float(f.beta[0]), f.loss, f.loss + q * len(f.support))
            for q, f in steps if len(f.support) <= max_support], sums


def fitted(step: Step, n_features: int) -> SparseLogisticModel:
    used = [(i, float(w)) for i, w in zip(step.support, step.coefficients) if w and math.isfinite(w)]
    return SparseLogisticModel(positions=[i for i, _ in used], weights=[w for _, w in used], bias=step.intercept,
                               size=n_features)
