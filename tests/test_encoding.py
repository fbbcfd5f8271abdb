import numpy as np
from pyspark.sql import functions as F

from panelforge.operators.encoding import BinaryEncoder, null_profile, percent_points, threshold_table


def _df(spark):
    rows = []
    for i in range(200):
        rows.append((str(i), float(i % 37) * 1.5 if i % 10 else None, 5.0, "Y" if i % 3 else None,
                     "P" if i % 2 else "Z", 1 if i % 2 else -1, 600 + i))
    return spark.createDataFrame(rows, "Loan_Num string, LTV double, Const double, Prepay_Penalty string, "
                                       "Occupancy_Status string, Default int, Credit_Score int")


def test_percent_points():
    assert len(percent_points(20)) == 19 and percent_points(20)[0] == 5.0
    assert len(percent_points(30)) == 32


def test_thresholds_match_numpy(spark):
    df = _df(spark)
    t = {r.col_name: r.thresholds for r in threshold_table(df, ["LTV", "Const"], 20).collect()}
    vals = np.array([r.LTV for r in df.collect() if r.LTV is not None])
    expect = np.unique(np.round(np.percentile(vals, np.arange(5, 100, 5)), 2))
    assert t["LTV"] == [float(x) for x in expect]
    assert t["Const"] == [5.0]                      # constant column: one threshold


def test_encoder_columns_and_semantics(spark):
    df = _df(spark)
    prof = {r.col_name: r.null_count for r in null_profile(df).collect()}
    assert prof == {"LTV": 20, "Prepay_Penalty": 67}
    enc = BinaryEncoder(yn_columns=["Prepay_Penalty"],
                        categorical_mappings={"Occupancy_Status": [("P", "Primary Res.")]},
                        num_thresholds=20, also_continuous=())
    model = enc.fit(df)
    out = model.transform(df)
    cols = out.columns
    assert "LTV is Missing" in cols and "Prepay_Penalty is Missing" in cols and "Const is Missing" not in cols
    assert "Prepay_Penalty = Yes" in cols and "Occupancy_Status = Primary Res." in cols
    assert "Prepay_Penalty" not in cols and "Occupancy_Status" not in cols and "LTV" not in cols
    assert "Const <= 5.0" in cols and "Credit_Score" in cols          # int columns are not thresholded
    r = out.where(F.col("Loan_Num") == "0").first().asDict()
    ltv = [c for c in cols if c.startswith("LTV <= ")]
    assert ltv and r["LTV is Missing"] == 1 and all(r[c] is None for c in ltv)   # null stays null
    assert r["Prepay_Penalty = Yes"] == 0 and r["Occupancy_Status = Primary Res."] == 0
    # same columns on another frame (fit on train, transform test)
    assert model.transform(df.limit(5)).columns == cols
    again = type(model).from_json(model.to_json())
    assert again.transform(df).columns == cols


def test_credit_score_floor_when_enabled(spark):
    df = _df(spark)
    t = {r.col_name: r.thresholds for r in threshold_table(df, ["Credit_Score"], 20).collect()}
    assert all(x % 50 == 0 for x in t["Credit_Score"])


def test_distributed_percentiles_equal_numpy(spark):
    import random
    rnd = random.Random(3)
    rows = [(float(rnd.choice([0.0, 0.0, 0.0, rnd.uniform(-5, 5)])), rnd.randint(0, 9) * 1.0) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double")
    dist = {r.col_name: r.thresholds for r in threshold_table(df, ["a", "b"], 30).collect()}
    for i, c in enumerate("ab"):
        expect = np.unique(np.round(np.percentile(np.array([r[i] for r in rows]), percent_points(30)), 2))
        assert dist[c] == [float(x) for x in expect]
