"""The L0 path against all subsets of a small frame, and the frames of its job."""

import itertools

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelforge.operators.models import TrainedModel, sparse_additive_path, train_sparse_additive
from panelforge.operators.sparse_l0 import Sums, l0_path, screen

RIDGE = 1e-6


def _data(seed, n=500, p=7):
    """Correlated indicators, one of them twice, one constant; only some matter."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 2))
    x = (base[:, rng.integers(0, 2, p)] + rng.normal(size=(n, p)) > rng.normal(size=p)).astype(float)
    x[:, p - 1], x[:, p - 2] = x[:, 0], 1.0
    eta = x[:, :4] @ rng.normal(size=4) * 1.5 - 0.3
    return x, (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float)


def _frame(spark, x, y):
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"f{i} double" for i in range(x.shape[1])) + ", label double").repartition(5)


def _loss(x, y, support):
    a = np.column_stack([np.ones(len(y)), x[:, list(support)]])
    held = np.r_[0, np.full(len(support), RIDGE)]
    b = np.zeros(a.shape[1])
    for _ in range(60):
        mu = 1 / (1 + np.exp(-a @ b))
        b -= np.linalg.lstsq((a * (mu * (1 - mu))[:, None]).T @ a / len(y) + np.diag(held),
                             a.T @ (mu - y) / len(y) + held * b, rcond=None)[0]
    eta = a @ b
    return (np.logaddexp(0, eta) - y * eta).mean() + (held * b * b).sum() / 2


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_no_subset_has_a_lower_objective(spark, seed):
    x, y = _data(seed)
    path, sums = l0_path(spark, _frame(spark, x, y), x.shape[1], max_support=7, num_lambda=25)
    best = {s: _loss(x, y, s) for k in range(8) for s in itertools.combinations(range(7), k)}
    assert len(path) == 25 and len(path[-1].support) >= 3
    for step in path:
        assert step.loss == pytest.approx(best[step.support], abs=1e-7)
        assert step.objective <= min(v + step.penalty * len(s) for s, v in best.items()) + 1e-7
    assert sums.jobs < 120


def test_sums_equal_numpy_through_the_tree(spark):
    x, y = _data(5)
    df = _frame(spark, x, y).select(F.array(*[f"f{i}" for i in range(7)]).alias("features"), "label").repartition(9)
    sums = Sums(df.cache(), 7, fan_in=2)
    points = [((1, 4), [0.2, -1.0, 0.5]), ((), [0.1])]
    for (s, b), (loss, g, h) in zip(points, sums(points)):
        a = np.column_stack([np.ones(len(y)), x[:, list(s)]])
        mu = 1 / (1 + np.exp(-a @ np.array(b)))
        assert loss == pytest.approx(-np.mean(y * np.log(mu) + (1 - y) * np.log(1 - mu)))
        assert np.allclose(g, a.T @ (mu - y) / len(y)) and np.allclose(h, (a * (mu * (1 - mu))[:, None]).T @ a / len(y))
    (_, g, h), = sums(points[:1], full=True)
    assert g.shape == (8,) and h.shape == (8, 8)


def test_screen_equals_closed_form(spark):
    x, y = _data(6)
    got = screen(spark, _frame(spark, x, y), 7)
    assert got == pytest.approx([_loss(x, y, (j,)) for j in range(7)], abs=1e-5)


def test_separable_and_one_class_data_stay_finite(spark):
    x = np.array([[1.0, 0.0]] * 20 + [[0.0, 1.0]] * 20)
    for y in (x[:, 0], np.ones(40)):
        path, _ = l0_path(spark, _frame(spark, x, y), 2, max_support=2, num_lambda=30)
        assert path and all(np.isfinite(s.coefficients).all() and np.isfinite(s.loss) for s in path)


def _binary(spark):
    rows = [(str(i), 1 if (i % 4 == 0) ^ (i % 17 == 0) else 0, (i % 3 == 0) * 1, None if i % 11 == 0 else 1,
             1 if i % 4 == 0 else -1) for i in range(300)]
    return spark.createDataFrame(rows, "Loan_Num string, `a <= 1.0` int, b int, c byte, Default int")


def test_model_is_a_saved_pipeline_stage(spark, tmpdir_path):
    df = _binary(spark)
    model, path = sparse_additive_path(df, max_support=2, num_lambda=30)
    assert model.features[path[-1].support[0]] == "a <= 1.0" and len(path[-1].support) <= 2
    loss = model.predict(df).agg(F.avg(F.when(F.col("label") == 1, -F.log("p_default")).otherwise(
        -F.log(1 - F.col("p_default"))))).first()[0]
    assert loss + RIDGE / 2 * (path[-1].coefficients ** 2).sum() == pytest.approx(path[-1].loss, abs=1e-6)
    model.save(tmpdir_path + "/m")
    assert PipelineModel.load(tmpdir_path + "/m").stages[-1].coefficients == model.pipeline.stages[-1].coefficients
    again = TrainedModel.load(tmpdir_path + "/m")
    assert sorted(map(tuple, again.predict(df).collect())) == sorted(map(tuple, model.predict(df).collect()))


def test_support_limit_holds(spark):
    m = train_sparse_additive(_binary(spark), max_support=1, num_lambda=20)
    assert len(m.pipeline.stages[-1].coefficients.indices) == 1
