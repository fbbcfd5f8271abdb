"""Sparse feature vectors against the encoded columns and MLlib's assembler."""

import pytest
from pyspark.ml.feature import VectorAssembler

from panelforge.operators.encoding import BinaryEncoder
from panelforge.operators.models import feature_columns, positional, train_random_forest


def _frame(spark, n=150):
    rows = [(str(i), None if i % 7 == 0 else float(i % 40) / 4, None if i % 11 == 0 else (i * 37) % 50, "YN"[i % 2] if i % 5 else None,
             "ABC"[i % 3], i % 4 if i % 9 else None, float("nan") if i % 13 == 0 else -float(i), 1 if i % 6 == 0 else -1) for i in range(n)]
    return spark.createDataFrame(rows, "Loan_Num string, x double, z long, flag string, kind string, count int, "
                                       "odd double, Default int").repartition(3)


def _encoder():
    return BinaryEncoder(yn_columns=["flag"], categorical_mappings={"kind": [("A", "first"), ("B", "second")]}, num_thresholds=10)


@pytest.mark.parametrize("missing", [0.0, -1.0])
def test_vectors_equal_the_assembled_columns(spark, missing):
    df = _frame(spark)
    model = _encoder().fit(df)
    wide = model.transform(df)
    names = feature_columns(wide)
    x = VectorAssembler(inputCols=[f"f{i}" for i in range(len(names))], outputCol="v", handleInvalid="keep").transform(
        positional(wide, names, missing=missing))
    want = {r.Loan_Num: r.v.toArray().tolist() for r in x.select("Loan_Num", "v").collect()}
    out = model.transform_vectors(df, missing=missing)
    got = {r.Loan_Num: r.features for r in out.collect()}
    assert {k: v.toArray().tolist() for k, v in got.items()} == want and len(names) > 25
    assert all(list(v.indices) == sorted(set(v.indices)) for v in got.values())


def test_plan_has_one_expression_per_source_column(spark):
    df = _frame(spark)
    model = _encoder().fit(df)
    plan = model.transform_vectors(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "<=" not in plan and plan.count("cast(") <= 4


def test_vectors_of_nothing_and_in_mllib(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.sql import functions as F
    df = _frame(spark)
    model = _encoder().fit(df)
    assert model.transform_vectors(df.limit(0)).count() == 0
    vectors = model.transform_vectors(df, missing=-1.0).withColumn("label", F.when(F.col("Default") == 1, 1.0).otherwise(0.0))
    forest = RandomForestClassifier(numTrees=3, maxDepth=3, seed=1).fit(vectors)
    wide = train_random_forest(model.transform(df), num_trees=3, max_depth=3, balanced=False, seed=1)
    assert forest.numFeatures == wide.pipeline.stages[-1].numFeatures
