"""End-to-end stages with their sinks: process -> sample (binary, with economic data) -> train."""

import pytest

from panelforge import config as C
from panelforge.operators.models import get_trainer
from panelforge.plans import pipeline as PL

SF = "/root/testdata/sf0.01"


def test_process_sample_train(spark, tmpdir_path):
    orig, perf = PL.loan_tables(spark, SF)
    processed = tmpdir_path + "/processed"
    PL.run_process(spark, orig, perf, processed)
    s = C.Settings(**{**PL.FIXTURE_SETTINGS.__dict__})
    econ = PL.economic_series(spark, SF)
    with pytest.raises(FileNotFoundError):
        PL.read_training_set(spark, tmpdir_path + "/sets")
    with pytest.raises(RuntimeError):
        bad = C.Settings(**{**s.__dict__, "quarters": [(2015, 1), (2016, 1)]})
        PL.run_sample(spark, processed, tmpdir_path + "/bad", bad)
    PL.run_sample(spark, processed, tmpdir_path + "/sets", s, binary=True, econ=econ)
    tr = PL.read_training_set(spark, tmpdir_path + "/sets")
    te = spark.read.parquet(tmpdir_path + "/sets/test_binary.parquet")
    assert tr.columns == te.columns                       # fitted on train, applied to both
    assert any(c.startswith("HPI_Change_yoy <= ") for c in tr.columns)
    assert "Credit_Score <= 300" in tr.columns             # special missing-indicator name
    n = tr.count()
    assert 0 < n <= s.train_size
    m = get_trainer("random_forest")(tr, num_trees=10, max_depth=4)
    assert m.predict(te).count() == te.count()
    path = PL.run_train(spark, tmpdir_path + "/sets", tmpdir_path + "/models", "random_forest",
                        num_trees=5, max_depth=3)
    assert path.endswith("random_forest_balanced")
    from panelforge.operators.models import TrainedModel
    assert TrainedModel.load(path).predict(te).count() == te.count()
    # plain (non-binary) sets keep the raw feature columns
    PL.run_sample(spark, processed, tmpdir_path + "/plain", s, binary=False)
    plain = spark.read.parquet(tmpdir_path + "/plain/train.parquet")
    assert plain.columns == s.dev_columns and plain.count() == n
