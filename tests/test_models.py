import pytest
from pyspark.sql import functions as F

from panelforge.operators.models import TrainedModel, class_weights, get_trainer, train_random_forest


def _binary(spark):
    rows = []
    for i in range(300):
        y = 1 if i % 4 == 0 else -1
        rows.append((str(i), 1 if (i % 4 == 0) ^ (i % 17 == 0) else 0, (i % 3 == 0) * 1, None if i % 11 == 0 else 1, y))
    return spark.createDataFrame(rows, "Loan_Num string, `a <= 1.0` int, b int, c byte, Default int")


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    w = {r.label: r.weight for r in class_weights(df).select("label", "weight").distinct().collect()}
    assert w == {0.0: 4 / (2 * 3), 1.0: 4 / (2 * 1)}


def test_random_forest_trains_and_reloads(spark, tmpdir_path):
    df = _binary(spark)
    m = train_random_forest(df, num_trees=5, max_depth=3)
    pred = m.predict(df)
    acc = pred.select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.8 and set(m.features) == {"a <= 1.0", "b", "c"}
    m.save(tmpdir_path + "/rf")
    m2 = TrainedModel.load(tmpdir_path + "/rf")
    assert m2.features == m.features and m2.predict(df).count() == 300


@pytest.mark.parametrize("name, params", [("random_forest", {"num_trees": 5, "max_depth": 3}),
                                          ("sparse_additive", {"max_support": 3, "num_lambda": 20})])
def test_reloaded_models_predict_the_same(spark, tmpdir_path, name, params):
    df = _binary(spark)
    m = get_trainer(name)(df, **params)
    m.save(tmpdir_path + "/m")
    before, after = (sorted(map(tuple, x.predict(df).collect())) for x in (m, TrainedModel.load(tmpdir_path + "/m")))
    assert before == after


def test_sparse_additive_support_limit(spark):
    m = get_trainer("sparse_additive")(_binary(spark), max_support=1, num_lambda=20)
    coef = m.pipeline.stages[-1].coefficients.toArray()
    assert (coef != 0).sum() <= 1


def test_unknown_trainer():
    with pytest.raises(ValueError):
        get_trainer("nope")
