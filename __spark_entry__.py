"""

Every query derives loan-shaped data from the benchmark tables of ``sf_dir``
(``panelforge.sources.fixtures``) and runs the engine's operators on it over the
whole tables. ``oracle_sql`` holds the same computation written independently in
DuckDB SQL (``panelforge.sources.fixtures_sql``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge import config as C
from panelforge.functions import month_end
from panelforge.operators import economic as E
from panelforge.operators import panel as P
from panelforge.operators import sampling as S
from panelforge.operators.encoding import BinaryEncoder, continuous_columns, null_profile, threshold_table
from panelforge.operators.models import class_weights, feature_columns, positional
from panelforge.plans import pipeline as PL
from panelforge.sources import fixtures as fx
from panelforge.sources import quarters as QS
from panelforge.sources import text as TX
from panelforge.session import checkpoint_dir, scratch_path

SF_SMOKE = "/root/testdata/sf0.001"
FS = PL.FIXTURE_SETTINGS


# ---------------------------------------------------------------- shared building blocks
def _panel(spark, d):
    return PL.processed_panel(spark, d)


def _sets(spark, d):
    return PL.development_sets(_panel(spark, d), FS)


def _dev_train(spark, d):
    train, _ = _sets(spark, d)
    return PL.project_features(train, FS)


LOG_COLUMNS = ["Log_UPB", "Log_Curr_UPB", "Log_Non_Int_Bear_UPB", "Log_Median_Ann_Income"]


def _round_logs(df: DataFrame, digits: int = 9) -> DataFrame:
    """log10 may differ in the last bit between engines: report logs to ``digits`` decimals."""
    return df.select(*[F.round(c, digits).alias(c) if c in LOG_COLUMNS else F.col(c) for c in df.columns])


def _lm(df: DataFrame) -> DataFrame:
    """Loan and month keys first (stable order for readers)."""
    rest = [c for c in df.columns if c not in ("Loan_Num", "Month")]
    return df.select("Loan_Num", "Month", *rest)


# ---------------------------------------------------------------- queries
def q_default_rate_by_month(spark, d):
    """Flagship: share of loans observed in month t that go bad in their next 12 observations."""
    orig, perf = PL.loan_tables(spark, d)
    lab = P.label_and_lookback(perf).join(orig.select("Loan_Num"), "Loan_Num", "inner")
    return (lab.groupBy("Month")
            .agg(F.count(F.lit(1)).alias("n_loans"), F.sum("Default").cast("long").alias("n_default"))
            .withColumn("default_rate", F.col("n_default").cast("double") / F.col("n_loans").cast("double")))


def q_scan_origination(spark, d):
    raw = fx.raw_origination(spark, d, with_vintage=False)
    path = scratch_path(spark, "orig-text")
    TX.write_pipe_text(raw, path)
    return TX.scan_origination(spark, path)


def q_scan_performance(spark, d):
    raw = fx.raw_performance(spark, d)
    path = scratch_path(spark, "perf-text")
    TX.write_pipe_text(raw, path)
    return TX.scan_performance(spark, path)


def q_month_end(spark, d):
    raw = fx.raw_performance(spark, d).select("Month").distinct()
    return raw.select(F.col("Month").alias("month_raw"), month_end("Month").alias("Month"))


def q_clean_origination(spark, d):
    orig, _ = PL.loan_tables(spark, d)
    return orig


def q_clean_performance(spark, d):
    _, perf = PL.loan_tables(spark, d)
    return perf.select("Loan_Num", "Month", "Current_Actual_UPB", "Current_Delinquency_Status", "Loan_Age",
                       "Months_to_Maturity", "Modification_Flag", "Zero_Balance_Code", "ELTV",
                       "Delinquency_Disaster_Flag")


def q_current_default(spark, d):
    _, perf = PL.loan_tables(spark, d)
    return perf.select("Loan_Num", "Month", "Current_Delinquency_Status", "Zero_Balance_Code",
                       P.current_default().alias("Current_Default"))


def q_forward_default_label(spark, d):
    _, perf = PL.loan_tables(spark, d)
    return P.forward_default_label(perf).select("Loan_Num", "Month", "Current_Default", "Default")


def q_trailing_features(spark, d):
    _, perf = PL.loan_tables(spark, d)
    return P.label_and_lookback(perf).select(
        "Loan_Num", "Month", "Default", "Max_Delinq_Severity_yoy", "Num_Modifications_yoy",
        "Delinq_Status_0_Count", "Delinq_Status_1_Count", "Delinq_Status_2_Count")


def q_drop_defective(spark, d):
    orig, perf = PL.loan_tables(spark, d)
    orig_ok, perf_ok = P.drop_defective(orig, perf)
    return perf_ok.groupBy("Loan_Num").agg(F.count(F.lit(1)).alias("n_months"))


def q_distinct_loans(spark, d):
    _, perf = PL.loan_tables(spark, d)
    return perf.where(F.col("Zero_Balance_Code") == "96").select("Loan_Num").distinct()


def q_semi_join_loans(spark, d):
    orig, perf = PL.loan_tables(spark, d)
    return P.semi_join_loans(perf, orig.where(F.col("Quarter") == 1)).select(
        "Loan_Num", "Month", "Current_Actual_UPB")


def q_panel_join(spark, d):
    orig, perf = PL.loan_tables(spark, d)
    lab = P.label_and_lookback(perf)
    j = lab.join(orig.select("Loan_Num", "UPB", "ZIP_Code", "Property_State", "Year", "Quarter"), "Loan_Num")
    return j.select("Loan_Num", "Month", "Default", "UPB", "ZIP_Code", "Property_State", "Year", "Quarter")


def q_loan_ratios(spark, d):
    return _panel(spark, d).select("Loan_Num", "Month", "Payment_Ratio", "Balance_Per_Month",
                                   "Maturity_Progress")


def q_log_money(spark, d):
    return _round_logs(_panel(spark, d).select("Loan_Num", "Month", "Log_UPB", "Log_Curr_UPB",
                                               "Log_Non_Int_Bear_UPB"))


def q_zip_default_rate(spark, d):
    return (_panel(spark, d).select("Year", "Quarter", "ZIP_Code", "Month", "ZIP_Default_Rate").distinct())


def q_signed_target(spark, d):
    return _panel(spark, d).select("Loan_Num", "Month", "Default")


def q_build_panel(spark, d):
    return _round_logs(_lm(_panel(spark, d).select(*PANEL_COLUMNS)))


def q_income_series(spark, d):
    return E.income(fx.raw_income(spark, d))


def q_unemployment_series(spark, d):
    return E.unemployment(fx.raw_unemployment(spark, d))


def q_inflation_series(spark, d):
    return E.inflation(fx.raw_inflation(spark, d))


def q_hpi_series(spark, d):
    return E.house_price_index(fx.raw_house_price_index(spark, d))


def q_rate_series(spark, d):
    return E.mortgage_rate(fx.raw_mortgage_rate(spark, d))


def q_release_lag(spark, d):
    return E.lagged(E.house_price_index(fx.raw_house_price_index(spark, d)), 14)


def _join_one(spark, d, which):
    panel = _panel(spark, d).select("Loan_Num", "Month", "First_Payment_Month", "ZIP_Code", "Property_State")
    ser = PL.economic_series(spark, d)
    if which == "income":
        return E.attach(panel, ser["income"], ["Month", "Property_State"], ["Month", "State"])
    if which == "unemployment":
        return E.attach(panel, E.lagged(ser["unemployment"], 1), ["Month", "ZIP_Code"], ["Month", "ZIP_Code"])
    if which == "inflation":
        return E.attach(panel, E.lagged(ser["inflation"], 1), ["Month"], ["Month"])
    if which == "hpi":
        h2 = E.lagged(ser["hpi"], 2)
        df = E.attach(panel, h2, ["Month", "ZIP_Code"], ["Month", "ZIP_Code"])
        df = E.attach(df, E.suffixed(h2, ["Month", "ZIP_Code"], "_Orig"),
                      ["First_Payment_Month", "ZIP_Code"], ["Month", "ZIP_Code"])
        return E.attach(df, E.suffixed(E.lagged(ser["hpi"], 14), ["Month", "ZIP_Code"], "_year"),
                        ["Month", "ZIP_Code"], ["Month", "ZIP_Code"])
    if which == "rate":
        df = E.attach(panel, ser["rate"], ["Month"], ["Month"])
        return E.attach(df, E.suffixed(ser["rate"], ["Month"], "_Orig"), ["First_Payment_Month"], ["Month"])
    raise ValueError(which)


def q_join_income(spark, d):
    return _join_one(spark, d, "income").select("Loan_Num", "Month", "Property_State", "Median_Ann_Income")


def q_join_unemployment(spark, d):
    return _join_one(spark, d, "unemployment").select("Loan_Num", "Month", "ZIP_Code", "Unemp_Rate")


def q_join_inflation(spark, d):
    return _join_one(spark, d, "inflation").select("Loan_Num", "Month", "Infl_Rate")


def q_join_hpi(spark, d):
    return _join_one(spark, d, "hpi").select("Loan_Num", "Month", "ZIP_Code", "HP_Index", "HP_Index_Orig",
                                             "HP_Index_year")


def q_join_rate(spark, d):
    return _join_one(spark, d, "rate").select("Loan_Num", "Month", "US_30yr_FRM", "US_30yr_FRM_Orig")


def q_econ_enrichment(spark, d):
    train, test = _sets(spark, d)
    ser = PL.economic_series(spark, d)
    df = E.enrich(S.union_samples(train, test), ser)
    return _round_logs(df.select("Loan_Num", "Month", "Set", *C.ECONOMIC_COLUMNS))


def q_obs_dates(spark, d):
    return S.at_obs_dates(_panel(spark, d), FS.train_obs_dates + FS.test_obs_dates).select(
        "Loan_Num", "Month", "Year", "Quarter", "Current_Delinquency_Status", "Zero_Balance_Code")


def q_performing_loans(spark, d):
    df = S.performing(S.at_obs_dates(_panel(spark, d), FS.train_obs_dates + FS.test_obs_dates))
    return df.select("Loan_Num", "Month", "Year", "Quarter", "Current_Delinquency_Status")


def q_stratified_sample(spark, d):
    train, _ = _sets(spark, d)
    return train.select("Loan_Num", "Month", "Year", "Quarter", "Default")


def q_test_sample(spark, d):
    _, test = _sets(spark, d)
    return test.select("Loan_Num", "Month", "Year", "Quarter", "Default")


def q_train_test_split(spark, d):
    obs = S.performing(_panel(spark, d))
    train, test = S.train_test_split(obs, FS.train_obs_dates, FS.test_obs_dates, 400, seed=FS.seed)
    return S.union_samples(train, test).select("Loan_Num", "Month", "Set")


def q_union_samples(spark, d):
    train, test = _sets(spark, d)
    return S.union_samples(train, test).select("Loan_Num", "Month", "Year", "Quarter", "Set")


def q_feature_projection(spark, d):
    return _round_logs(_dev_train(spark, d))


def q_null_profile(spark, d):
    return null_profile(_dev_train(spark, d))


def q_percentile_thresholds(spark, d):
    tr = _dev_train(spark, d)
    cols = [c for c in continuous_columns(tr) if c not in set(FS.yn_columns) | set(FS.categorical_mappings)]
    t = threshold_table(tr, cols, FS.num_thresholds)
    return t.select("col_name", F.explode("thresholds").alias("threshold"))


def _encoded_long(df: DataFrame, model, only=None) -> DataFrame:
    """Encoded frame in long form (Loan_Num, Month, feature, value): one array of
    (feature, value) structs per row, exploded (a Generate, evaluated once per row)."""
    enc = model.transform(df)
    names = [c for c in enc.columns if c not in df.columns]
    if only is not None:
        names = [n for n in names if only(n)]
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("int").alias("value"))
                      for n in names])
    return enc.select("Loan_Num", "Month", F.explode(pairs).alias("_fv")).select(
        "Loan_Num", "Month", "_fv.feature", "_fv.value")


def q_missing_indicators(spark, d):
    tr = _dev_train(spark, d)
    model = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(tr)
    model.thresholds, model.yn_columns, model.categorical_mappings = {}, [], {}
    return _encoded_long(tr, model)


def q_category_encoding(spark, d):
    tr = _dev_train(spark, d)
    model = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(tr)
    model.thresholds, model.missing_cols = {}, []
    return _encoded_long(tr, model)


def q_threshold_encoding(spark, d):
    tr = _dev_train(spark, d)
    model = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(tr)
    model.missing_cols, model.yn_columns, model.categorical_mappings = [], [], {}
    return _encoded_long(tr, model)


def q_binary_encoding(spark, d):
    """Encoder fitted on the training set, applied to the test set (long form)."""
    train, test = _sets(spark, d)
    tr, te = PL.project_features(train, FS), PL.project_features(test, FS)
    model = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(tr)
    return _encoded_long(te, model)


def q_thermometer_vectors(spark, d):
    """The non-zero indicators of the test set's sparse feature vectors (encoder fitted on the
    training set)."""
    train, test = _sets(spark, d)
    tr, te = PL.project_features(train, FS), PL.project_features(test, FS)
    model = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(tr)
    names = feature_columns(model.transform(te.limit(0)))
    entry_ = F.explode(F.arrays_zip(F.col("v.indices").alias("i"), F.col("v.values").alias("x")))
    long = model.transform_vectors(te).select("Loan_Num", "Month", F.unwrap_udt("features").alias("v")).select(
        "Loan_Num", "Month", entry_.alias("e"))
    long = long.select("Loan_Num", "Month", F.element_at(F.lit(names), F.col("e.i") + 1).alias("feature"),
                       F.col("e.x").cast("int").alias("value"))
    return long.where(~F.col("feature").isin(te.columns))


def q_class_weights(spark, d):
    x = positional(_dev_train(spark, d), [], "Default")
    w = class_weights(x)
    return w.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n"))


def _binary_sets(spark, d):
    train, test = _sets(spark, d)
    tr, te, _ = PL.encode_sets(PL.project_features(train, FS), PL.project_features(test, FS), FS)
    return tr, te


def _checked(pred: DataFrame, *extra) -> DataFrame:
    """Keys and label with what must hold of any right model (the probabilities themselves
    depend on the optimiser)."""
    return pred.select("Loan_Num", "Month", F.col("label").cast("int").alias("label"),
                       F.col("p_default").between(0.0, 1.0).cast("int").alias("p_in_range"),
                       (F.col("prediction") == (F.col("p_default") > 0.5).cast("double")).cast("int").alias("consistent"),
                       *extra)


def q_train_random_forest(spark, d):
    from panelforge.operators.models import train_random_forest
    tr, te = _binary_sets(spark, d)
    m = train_random_forest(tr, num_trees=FS.rf_num_trees, max_depth=FS.rf_max_depth, balanced=True)
    return _checked(m.predict(te))


def q_train_monotone_forest(spark, d):
    """Also whether the probability lies between those of the row with all constrained threshold
    indicators set to the safer and to the riskier side."""
    from panelforge.operators.models import feature_columns, monotone_signs, train_monotone_forest
    tr, te = _binary_sets(spark, d)
    m = train_monotone_forest(tr, num_trees=FS.rf_num_trees, max_depth=FS.rf_max_depth, balanced=True)
    signs = {c: s for c, s in zip(m.features, monotone_signs(m.features)) if " <= " in c}

    def moved(risk: int, name: str) -> DataFrame:
        cols = [F.when(F.col(f"`{c}`").isNotNull(), int(signs[c] == risk)).cast(te.schema[c].dataType).alias(c)
                if signs.get(c) else F.col(f"`{c}`") for c in te.columns]
        return m.predict(te.select(*cols)).select("Loan_Num", "Month", F.col("p_default").alias(name))

    pred = m.predict(te).join(moved(-1, "p_safe"), ["Loan_Num", "Month"]).join(moved(1, "p_risky"), ["Loan_Num", "Month"])
    return _checked(pred, F.col("p_default").between(F.col("p_safe"), F.col("p_risky")).cast("int").alias("ordered"))


def q_monotone_splits(spark, d):
    """Every first split of the encoded training set: weighted shares of defaults on both sides,
    gain, and whether the constraints let it be made."""
    from panelforge.operators.models import monotone_signs
    from panelforge.operators.monotone_forest import binned, root_splits
    train, _ = _sets(spark, d)
    train = PL.project_features(train, FS)
    encoded = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(train).transform(train)
    names = [c for c in encoded.columns if c not in train.columns]
    data = binned(spark, positional(encoded, names), len(names), F.xxhash64("Loan_Num", "Month"))
    return root_splits(data, monotone_signs(names)).select(
        F.element_at(F.lit(names), (F.col("feature") + 1).cast("int")).alias("feature"),
        F.col("at_most").cast("int").alias("at_most"), F.round("p_left", 6).alias("p_left"),
        F.round("p_right", 6).alias("p_right"), F.round("gain", 6).alias("gain"),
        (F.col("allowed") & (F.col("gain") > 1e-9)).cast("int").alias("made"))


def q_train_sparse_additive(spark, d):
    from panelforge.operators.models import train_sparse_additive
    tr, te = _binary_sets(spark, d)
    m = train_sparse_additive(tr, max_support=FS.sparse_max_support, num_lambda=FS.sparse_num_lambda,
                              scale_down=FS.sparse_scale_down)
    support = len(m.pipeline.stages[-1].coefficients.indices)
    return _checked(m.predict(te), F.lit(int(0 < support <= FS.sparse_max_support)).alias("support_ok"))


def q_sparse_screen(spark, d):
    """Log-loss of the one-feature logistic model of every encoded indicator (training set)."""
    from panelforge.operators.sparse_l0 import screen
    train, _ = _sets(spark, d)
    train = PL.project_features(train, FS)
    encoded = BinaryEncoder(num_thresholds=FS.num_thresholds).fit(train).transform(train)
    names = [c for c in encoded.columns if c not in train.columns]
    loss = screen(spark, positional(encoded, names, missing=0.0), len(names))
    return spark.createDataFrame(list(zip(names, map(float, loss))), "feature string, loss double").select(
        "feature", F.round("loss", 5).alias("loss"))


def q_quarter_spine(spark, d):
    perf = fx.raw_performance(spark, d).select(month_end("Month").alias("Month"))
    return QS.spine_from_months(perf, "Month")


def q_missing_quarters(spark, d):
    perf = fx.raw_performance(spark, d).select(month_end("Month").alias("Month"))
    wanted = QS.spine_from_months(perf, "Month")
    lab = _panel(spark, d).select(F.year("Month").alias("Year"), F.quarter("Month").alias("Quarter"))
    return QS.missing_quarters(wanted, lab)


def q_scan_processed(spark, d):
    orig, perf = PL.loan_tables(spark, d)
    path = scratch_path(spark, "processed")
    PL.run_process(spark, orig, perf, path)
    df = PL.read_processed(spark, path, [(2015, 2)])
    return df.select("Loan_Num", "Month", "Year", "Quarter", "Default", "ZIP_Default_Rate")


def _write_fixture_archives(spark, d) -> str:
    """Origination and performance text of every vintage as zip archives in the shared
    folder (as the loan data is published: one archive family per origination quarter)."""
    from panelforge.sources.archives import write_archives
    out = scratch_path(spark, "archives")
    orig = fx.raw_origination(spark, d, with_vintage=False)
    perf = fx.raw_performance(spark, d)
    vq = lambda: F.concat(F.lit("2015Q"), (F.col("Loan_Num").cast("long") % 4 + 1).cast("string"))
    write_archives(orig.withColumns({"_a": F.concat(F.lit("historical_data_"), vq()),
                                     "_m": F.concat(F.lit("historical_data_"), vq())}), out, "_a", "_m")
    write_archives(perf.withColumns({"_a": F.concat(F.lit("historical_data_"), vq()),
                                     "_m": F.concat(F.lit("historical_data_time_"), vq())}), out, "_a", "_m")
    return out


def q_ingest_archives(spark, d):
    from panelforge.sources.archives import ingest_loan_archives
    out = _write_fixture_archives(spark, d)
    _, perf = ingest_loan_archives(spark, out + "/*.zip")
    return perf.drop("Year", "Quarter")


def q_ingest_origination(spark, d):
    from panelforge.sources.archives import ingest_loan_archives
    orig, _ = ingest_loan_archives(spark, _write_fixture_archives(spark, d) + "/*.zip")
    return orig


def q_landed_performance(spark, d):
    """Performance rows of a table landed with the origination rows in one pass."""
    from panelforge.sources.archive_source import land_archives
    return land_archives(spark, _write_fixture_archives(spark, d))[1].drop("Year", "Quarter")


def q_landed_origination(spark, d):
    """Origination rows of the archives landed by a stream."""
    from panelforge.sources.archive_source import land_new_archives, landed
    path = scratch_path(spark, "landed")
    land_new_archives(spark, _write_fixture_archives(spark, d), path, scratch_path(spark, "landing-ckpt"))
    return landed(spark, path)[0]


def q_audit_archives(spark, d):
    from panelforge.sources.archives import add_broken_archives, audit_archives
    out = _write_fixture_archives(spark, d)
    add_broken_archives(spark, out)
    kind = F.regexp_extract("path", r"(historical_data(?:_time)?_\d{4}Q\d|truncated|empty|text)(?:-p\d+)?\.zip$", 1)
    return (audit_archives(spark, out + "/*.zip").groupBy(kind.alias("archive"))
            .agg(F.max(F.col("is_zip").cast("int")).alias("is_zip"), F.max("n_members").alias("n_members"),
                 F.max(F.col("error").isNotNull().cast("int")).alias("broken")))


def _incremental(spark, d, **kw):
    from panelforge.streaming.incremental import process_new_archives
    out = _write_fixture_archives(spark, d)
    processed = scratch_path(spark, "processed-stream")
    process_new_archives(spark, out, processed, scratch_path(spark, "stream-ckpt"), **kw)
    return spark.read.parquet(processed).select("Loan_Num", "Month", "Year", "Quarter", "Default",
                                                "ZIP_Default_Rate")


def q_incremental_process(spark, d):
    return _incremental(spark, d)


def q_incremental_by_file(spark, d):
    """One archive per micro-batch, so every vintage is completed by a late archive."""
    return _incremental(spark, d, max_files_per_trigger=1)


def q_written_sets(spark, d):
    """Process and sample stages through their sinks, then the sets read back."""
    orig, perf = PL.loan_tables(spark, d)
    processed, sets = scratch_path(spark, "processed-sets"), scratch_path(spark, "sets")
    PL.run_process(spark, orig, perf, processed)
    PL.run_sample(spark, processed, sets, FS)
    train, test = (spark.read.parquet(f"{sets}/{n}.parquet") for n in ("train", "test"))
    return S.union_samples(train, test).select("Loan_Num", "Month", "Set")


PANEL_COLUMNS = [
    "Loan_Num", "Month", "Year", "Quarter", "Default", "Current_Default", "Current_Actual_UPB",
    "Current_Delinquency_Status", "Loan_Age", "Months_to_Maturity", "Modification_Flag", "Zero_Balance_Code",
    "Current_Int_Rate", "Current_Non_Int_UPB", "Step_Modification_Flag", "Payment_Deferral_Flag", "ELTV",
    "Delinquency_Disaster_Flag", "Borrower_Assistance_Status_Code", "Max_Delinq_Severity_yoy",
    "Num_Modifications_yoy", "Delinq_Status_0_Count", "Delinq_Status_1_Count", "Delinq_Status_2_Count",
    "Credit_Score", "First_Payment_Month", "First_Time_Home_Buyer_Flag", "MI_Percentage", "Num_Units",
    "Occupancy_Status", "CLTV", "DTI", "UPB", "LTV", "Int_Rate", "Channel", "Prepay_Penalty",
    "Amortization_Type", "Property_State", "Property_Type", "ZIP_Code", "Loan_Purpose", "Loan_Term",
    "Num_Borrowers", "Sup_Conforming_Flag", "Program_Indicator", "Ref_Indicator", "Property_Val_Meth",
    "Int_Only_Indicator", "MI_Canc_Indicator", "Payment_Ratio", "Balance_Per_Month", "Maturity_Progress",
    "Log_UPB", "Log_Curr_UPB", "Log_Non_Int_Bear_UPB", "ZIP_Default_Rate",
]

_QUERIES = {
    "default_rate_by_month": q_default_rate_by_month,
    "scan_origination": q_scan_origination,
    "scan_performance": q_scan_performance,
    "month_end": q_month_end,
    "clean_origination": q_clean_origination,
    "clean_performance": q_clean_performance,
    "current_default": q_current_default,
    "forward_default_label": q_forward_default_label,
    "trailing_features": q_trailing_features,
    "drop_defective": q_drop_defective,
    "distinct_loans": q_distinct_loans,
    "semi_join_loans": q_semi_join_loans,
    "panel_join": q_panel_join,
    "loan_ratios": q_loan_ratios,
    "log_money": q_log_money,
    "zip_default_rate": q_zip_default_rate,
    "signed_target": q_signed_target,
    "build_panel": q_build_panel,
    "income_series": q_income_series,
    "unemployment_series": q_unemployment_series,
    "inflation_series": q_inflation_series,
    "hpi_series": q_hpi_series,
    "rate_series": q_rate_series,
    "release_lag": q_release_lag,
    "join_income": q_join_income,
    "join_unemployment": q_join_unemployment,
    "join_inflation": q_join_inflation,
    "join_hpi": q_join_hpi,
    "join_rate": q_join_rate,
    "econ_enrichment": q_econ_enrichment,
    "obs_dates": q_obs_dates,
    "performing_loans": q_performing_loans,
    "stratified_sample": q_stratified_sample,
    "test_sample": q_test_sample,
    "train_test_split": q_train_test_split,
    "union_samples": q_union_samples,
    "feature_projection": q_feature_projection,
    "null_profile": q_null_profile,
    "percentile_thresholds": q_percentile_thresholds,
    "missing_indicators": q_missing_indicators,
    "category_encoding": q_category_encoding,
    "threshold_encoding": q_threshold_encoding,
    "binary_encoding": q_binary_encoding,
    "thermometer_vectors": q_thermometer_vectors,
    "class_weights": q_class_weights,
    "train_random_forest": q_train_random_forest,
    "train_monotone_forest": q_train_monotone_forest,
    "monotone_splits": q_monotone_splits,
    "train_sparse_additive": q_train_sparse_additive,
    "sparse_screen": q_sparse_screen,
    "quarter_spine": q_quarter_spine,
    "missing_quarters": q_missing_quarters,
    "scan_processed": q_scan_processed,
    "ingest_archives": q_ingest_archives,
    "ingest_origination": q_ingest_origination,
    "landed_performance": q_landed_performance,
    "landed_origination": q_landed_origination,
    "audit_archives": q_audit_archives,
    "incremental_process": q_incremental_process,
    "incremental_by_file": q_incremental_by_file,
    "written_sets": q_written_sets,
}


def entry(spark: SparkSession) -> DataFrame:
    checkpoint_dir(spark)
    return q_default_rate_by_month(spark, SF_SMOKE)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, where that subpackage is present."""
    try:
        import corpus_pipeline
        from panelforge.llm import queries as llm
    except ImportError as e:
        if e.name in ("corpus_pipeline", "panelforge.llm", "panelforge.llm.queries"):
            return {}, {}
        raise
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.ORACLE, **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in {**_QUERIES, **_training_data()[0]}.items()}


def oracle_sql() -> dict[str, str]:
    from panelforge.sources.oracle_queries import ORACLE
    return {**ORACLE, **_training_data()[1]}
