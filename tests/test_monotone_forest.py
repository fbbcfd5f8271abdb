"""The forest against trees grown row by row, its constraints, and what must not change it."""

import itertools

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelforge.operators import monotone_forest as M
from panelforge.operators.models import TrainedModel, feature_columns, monotone_signs, positional, train_monotone_forest


def _data(seed, n=400, p=5):
    """Indicators with missing values (-1), one whole-number and one continuous feature."""
    rng = np.random.default_rng(seed)
    x = (rng.random((n, p)) < rng.uniform(0.2, 0.8, p)).astype(float)
    x[rng.random((n, p)) < 0.08] = -1
    x = np.column_stack([x, rng.integers(0, 6, n), rng.normal(size=n)])
    eta = x[:, :3] @ rng.normal(size=3) + 0.4 * x[:, p] * (x[:, 0] > 0) + 0.5 * x[:, -1] - 0.5
    return x, (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float)


def _frame(spark, x, y, parts=5):
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    ddl = "id long, " + ", ".join(f"f{i} double" for i in range(x.shape[1])) + ", label double"
    return spark.createDataFrame(rows, ddl).repartition(parts)


def _tree(x, y, w, cuts, signs, low, high, depth):
    """Recursive: the leaf share, or (feature, threshold, left, right)."""
    share = lambda at: w[at & (y == 1)].sum() / w[at].sum()
    every = np.ones(len(y), bool)
    best = None
    if depth:
        gini = lambda at: 2 * w[at].sum() * share(at) * (1 - share(at))
        for j in range(x.shape[1]):
            for c in cuts[j]:
                a = x[:, j] <= c
                if a.all() or not a.any():
                    continue
                pl, pr = share(a), share(~a)
                sign = 0 if c == -1 else signs[j]
                if sign * (pr - pl) < 0 or not low <= min(pl, pr) <= max(pl, pr) <= high:
                    continue
                gain = (gini(every) - gini(a) - gini(~a)) / w.sum()
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-13):
                    best = (gain, j, c, a, sign, (pl + pr) / 2)
    if best is None:
        return share(every)
    _, j, c, a, sign, mid = best
    ends = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[sign]
    return (j, c, *[_tree(x[s], y[s], w[s], cuts, signs, *e, depth - 1) for s, e in zip((a, ~a), ends)])


def _value(tree, r):
    while isinstance(tree, tuple):
        tree = tree[2] if r[tree[0]] <= tree[1] else tree[3]
    return tree


def _scores(model, df):
    rows = model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).collect()
    return np.array([r.p for r in sorted(rows, key=lambda r: r.id)])


@pytest.mark.parametrize("seed, signs", [(0, [0] * 7), (1, [1, -1, 0, 1, 0, -1, 1]), (2, [-1, -1, -1, 1, 1, 1, -1])])
def test_one_tree_equals_a_recursive_one(spark, seed, signs):
    x, y = _data(seed)
    df = _frame(spark, x, y)
    data = M.binned(spark, df, 7, F.col("id"), max_bins=16)
    assert [list(c) for c in data.cuts[:6]] == [[-1.0, 0.0]] * 5 + [[0.0, 1.0, 2.0, 3.0, 4.0]] and len(data.cuts[6]) == 15
    model = M.grow(data, signs, 1, 4, None, drawn_features=7)
    w = np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (1 - y).sum())
    tree = _tree(x, y, w, data.cuts, signs, 0.0, 1.0, 4)
    assert isinstance(tree, tuple)
    np.testing.assert_allclose(_scores(model, df), [_value(tree, r) for r in x], atol=1e-12)


def test_probabilities_follow_the_signs(spark):
    x, y = _data(3)
    y = np.where(np.random.default_rng(9).random(len(y)) < 0.4, 1 - y, y)  # noise to break the order
    data = M.binned(spark, _frame(spark, x, y), 7, F.col("id"), max_bins=8)
    grid = np.array(list(itertools.product(*[(-1, 0, 1)] * 3, (0, 1), (0, 1), (0, 2, 5), (-1.0, 0.0, 1.0))), float)
    frame = _frame(spark, grid, np.zeros(len(grid)))
    broken = []
    for signs in ([1, -1, 1, 0, 0, 1, -1], [0] * 7):
        p = _scores(M.grow(data, signs, 12, 5, 7), frame)
        found = 0
        for j, sign in enumerate([1, -1, 1, 0, 0, 1, -1]):
            key = [tuple(np.delete(r, j)) for r in grid]
            for a, b in _steps(grid, key, j):
                found += sign * (p[b] - p[a]) < -1e-12
        broken.append(found)
    assert broken[0] == 0 < broken[1]


def _steps(grid, key, j):
    """Pairs that differ in feature j alone, in ascending known values."""
    lines = {}
    for i in np.argsort(grid[:, j], kind="stable"):
        if j > 4 or grid[i, j] >= 0:
            lines.setdefault(key[i], []).append(i)
    return [pair for line in lines.values() for pair in zip(line[:-1], line[1:])]


def test_same_forest_however_rows_lie_and_trees_are_grouped(spark, monkeypatch):
    x, y = _data(4)
    one = M.grow(M.binned(spark, _frame(spark, x, y, 1), 7, F.col("id")), [0] * 7, 6, 3, 5)
    monkeypatch.setattr(M, "GROUP_BYTES", 1)  # a pass for every tree
    two = M.grow(M.binned(spark, _frame(spark, x, y, 9), 7, F.col("id")), [0] * 7, 6, 3, 5)
    for param in ("features", "thresholds", "values"):
        assert one.getOrDefault(param) == two.getOrDefault(param)
    feats = np.array(one.getOrDefault("features")).reshape(6, -1)
    assert len({tuple(t) for t in feats.tolist()}) > 1  # trees differ
    w = np.concatenate([M.draws(np.arange(20_000), t, 5) for t in range(5)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03


def test_one_class_no_rows_no_features(spark):
    x, _ = _data(6, n=30)
    for y in (np.zeros(30), np.ones(30)):
        df = _frame(spark, x, y)
        model = M.grow(M.binned(spark, df, 7, F.col("id")), [0] * 7, 2, 3, 1)
        assert set(_scores(model, df)) == {y[0]}
    none = _frame(spark, x, np.zeros(30)).limit(0)
    assert M.grow(M.binned(spark, none, 7, F.col("id")), [0] * 7, 2, 3, 1).transform(none).count() == 0


def test_train_save_load(spark, tmpdir_path):
    x, y = _data(8, n=300)
    names = ["CLTV <= 80.0", "Credit_Score <= 700.0", "Channel Retail", "DTI <= 30.0", "LTV <= 60.0", "Int_Rate", "Score"]
    rows = [(str(i), "2021-03", int(2 * v - 1), *map(float, r)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["Loan_Num", "Month", "Default", *names])
    assert feature_columns(df) == names and monotone_signs(names) == [-1, 1, 0, -1, -1, 1, 0]
    model = train_monotone_forest(df, num_trees=5, max_depth=3)
    model.save(tmpdir_path + "/m")
    got = {r.Loan_Num: r.p_default for r in TrainedModel.load(tmpdir_path + "/m").predict(df).collect()}
    assert got == {r.Loan_Num: r.p_default for r in model.predict(df).collect()} and len(set(got.values())) > 5
    assert positional(df, names).columns[:2] == ["Loan_Num", "Month"]
