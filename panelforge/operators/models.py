"""Classifiers on the binary development set (MLlib, distributed training).

Feature columns are everything except the keys and the target; string columns
that were never encoded are left out (MLlib needs numbers). Names such as
``LTV <= 80.0`` cannot be resolved by ``VectorAssembler`` (dots), so columns are
aliased to positional names and the real names are kept on the model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .monotone_forest import binned, grow
from .sparse_l0 import fitted, l0_path

LABEL = "label"
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.BooleanType)


def feature_columns(df: DataFrame, exclude=C.ENCODER_KEY_COLUMNS) -> list:
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, NUMERIC)]


def positional(df: DataFrame, features: list, target: str = "Default",
               missing: float | None = -1.0) -> DataFrame:
    """Features renamed f0..fn (double), label 1.0 for default (+1), 0.0 otherwise.
    A missing feature value (a threshold indicator of a null source) becomes ``missing``
    (-1: its own branch for trees, as native missing-value support would give)."""
    keep = [c for c in C.ENCODER_KEY_COLUMNS if c in df.columns and c != target]
    feats = [F.col(f"`{c}`").cast("double") for c in features]
    if missing is not None:
        feats = [F.coalesce(x, F.lit(missing)) for x in feats]
    return df.select(*keep, *[x.alias(f"f{i}") for i, x in enumerate(feats)],
                     F.when(F.col(target) == 1, 1.0).otherwise(0.0).alias(LABEL))


def class_weights(df: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Balanced class weights ``n / (k * n_class)`` attached to each row. The weight
    table has one row per class, so its broadcast is bounded."""
    every = Window.partitionBy()  # over one row per class
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    w = counts.withColumns({"_n": F.sum("_nc").over(every), "_k": F.count(F.lit(1)).over(every)}).select(
        label, (F.col("_n").cast("double") / (F.col("_k") * F.col("_nc")).cast("double")).alias(out))
    return df.join(F.broadcast(w), label, "left")


@dataclass
class TrainedModel:
    pipeline: PipelineModel
    features: list
    missing: float | None = -1.0

    def predict(self, df: DataFrame, target: str = "Default") -> DataFrame:
        x = positional(df, self.features, target, self.missing)
        keys = [c for c in C.ENCODER_KEY_COLUMNS if c in x.columns and c != target]
        out = self.pipeline.transform(x)
        return out.select(*keys, F.col(LABEL), F.col("prediction"), _prob1(out).alias("p_default"))

    def save(self, path: str) -> None:
        """MLlib persistence; the feature names go next to it as plain text."""
        self.pipeline.write().overwrite().save(path)
        spark = _active_session()
        spark.createDataFrame([(i, n, self.missing) for i, n in enumerate(self.features)],
                              "pos int, name string, missing double").coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + "/_features")

    @staticmethod
    def load(path: str) -> "TrainedModel":
        spark = _active_session()
        rows = spark.read.parquet(path.rstrip("/") + "/_features").orderBy("pos").collect()
        return TrainedModel(PipelineModel.load(path), [r["name"] for r in rows], rows[0]["missing"] if rows else -1.0)


def _active_session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _prob1(df: DataFrame):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(df["probability"])[1]


def _assembler(n: int) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"f{i}" for i in range(n)], outputCol="features",
                           handleInvalid="keep")


def train_random_forest(df: DataFrame, num_trees: int = 200, max_depth: int = 7,
                        balanced: bool = True, seed: int = 2001, target: str = "Default") -> TrainedModel:
    feats = feature_columns(df)
    x = positional(df, feats, target)
    weight = None
    if balanced:
        x = class_weights(x)
        weight = "weight"
    rf = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, labelCol=LABEL,
                                featuresCol="features", seed=seed, **({"weightCol": weight} if weight else {}))
    model = Pipeline(stages=[_assembler(len(feats)), rf]).fit(x)
    return TrainedModel(model, feats)


def monotone_signs(features: list, increasing=C.RISK_RISES_WITH, decreasing=C.RISK_FALLS_WITH) -> list:
    """Sign of every feature for default to become likelier with each column of ``increasing`` and
    less likely with each of ``decreasing``. An indicator ``column <= t`` is 1 for small values, so
    its sign is the opposite of its column's; a column that was never encoded has its own."""
    signs = {c: 1 for c in increasing} | {c: -1 for c in decreasing}
    return [-signs.get(f.split(" <= ")[0], 0) if " <= " in f else signs.get(f, 0) for f in features]


def train_monotone_forest(df: DataFrame, num_trees: int = 200, max_depth: int = 7, balanced: bool = True, seed: int = 2001,
                          increasing=C.RISK_RISES_WITH, decreasing=C.RISK_FALLS_WITH, target: str = "Default") -> TrainedModel:
    """Random forest whose probability of default never falls with a column of ``increasing`` and
    never rises with one of ``decreasing``. Rows without key columns draw their bootstrap by their
    features, so equal rows are drawn alike."""
    feats = feature_columns(df)
    x = positional(df, feats, target)
    keys = [c for c in C.ENCODER_KEY_COLUMNS if c in x.columns] or [f"f{i}" for i in range(len(feats))]
    data = binned(df.sparkSession, x, len(feats), F.xxhash64(*keys))
    model = grow(data, monotone_signs(feats, increasing, decreasing), num_trees, max_depth, seed, balanced=balanced)
    return TrainedModel(PipelineModel(stages=[model]), feats)


def train_sparse_additive(df: DataFrame, max_support: int = 40, num_lambda: int = 150,
                          scale_down: float = 0.8, target: str = "Default") -> TrainedModel:
    """Logistic model with at most ``max_support`` features: the last model of the L0 penalty
    path of ``sparse_l0.l0_path``. Missing feature values count as 0."""
    model, _ = sparse_additive_path(df, max_support, num_lambda, scale_down, target)
    return model


def sparse_additive_path(df: DataFrame, max_support: int = 40, num_lambda: int = 150, scale_down: float = 0.8,
                         target: str = "Default") -> tuple[TrainedModel, list]:
    """``train_sparse_additive`` and the steps of its path."""
    feats = feature_columns(df)
    path, _ = l0_path(df.sparkSession, positional(df, feats, target, missing=0.0), len(feats), max_support,
                      num_lambda, scale_down)
    return TrainedModel(PipelineModel(stages=[fitted(path[-1], len(feats))]), feats, missing=0.0), path


# Trainer registry: name -> function(df, **params) -> TrainedModel
TRAINERS = {"random_forest": train_random_forest, "monotone_forest": train_monotone_forest, "sparse_additive": train_sparse_additive}


def get_trainer(name: str):
    try:
        return TRAINERS[name]
    except KeyError:
        raise ValueError(f"unknown model '{name}'; available: {sorted(TRAINERS)}") from None
