"""DuckDB SQL for every registered query (the correctness oracle).

Column names equal the Spark outputs. Built from the CTEs of ``fixtures_sql``.
"""

from __future__ import annotations

from .. import config as C
from .fixtures_sql import TEST_DATES, TRAIN_DATES, _month_list, cte, sampled_cte, sql

SEED = 2001


def _q(c: str) -> str:
    return f'"{c}"'


N_TRAIN = 1600 // 4 // len(TRAIN_DATES)
N_TEST = 1000 // 4 // len(TEST_DATES)
N_SPLIT = 400 // len(TRAIN_DATES)

sampled_cte("train_s", TRAIN_DATES, N_TRAIN, SEED)
sampled_cte("test_s", TEST_DATES, N_TEST, SEED)
cte("train_dev", "SELECT " + ", ".join(_q(c) for c in C.MORTGAGE_COLUMNS) + " FROM train_s")
cte("test_dev", "SELECT " + ", ".join(_q(c) for c in C.MORTGAGE_COLUMNS) + " FROM test_s")

# continuous (double / bigint) development columns left after categorical encoding
CONTINUOUS = ["MI_Percentage", "CLTV", "DTI", "Log_UPB", "LTV", "Int_Rate", "Log_Curr_UPB", "Current_Int_Rate",
              "Log_Non_Int_Bear_UPB", "ELTV", "Payment_Ratio", "Balance_Per_Month", "Maturity_Progress",
              "ZIP_Default_Rate"]
QS = ", ".join(str(q / 100.0) for q in range(5, 100, 5))

PERF_NULL_COLS = {
    "Defect_Settlement_Date": "VARCHAR", "Zero_Balance_Effective_Date": "VARCHAR", "DDLPI": "VARCHAR",
    "MI_Recoveries": "DOUBLE", "Net_Sale_Proceeds": "DOUBLE", "Non_MI_Recoveries": "DOUBLE",
    "Total_Expenses": "DOUBLE", "Legal_Costs": "DOUBLE", "Maintenance_And_Preservation_Costs": "DOUBLE",
    "Taxes_And_Insurance": "DOUBLE", "Miscellaneous_Expenses": "DOUBLE", "Actual_Loss": "DOUBLE",
    "Cum_Modification_Cost": "DOUBLE", "Zero_Bal_Removal_UPB": "DOUBLE", "Delinquent_Accrued_Int": "DOUBLE",
    "Curr_Month_Modification_Cost": "DOUBLE", "Curr_Int_UPB": "DOUBLE",
}


def _thresholds_cte(name: str, src: str) -> None:
    parts = []
    for c in CONTINUOUS:
        parts.append(f"""SELECT '{c}' AS col_name, unnest(quantile_cont({c}, [{QS}])) AS p
FROM {src} WHERE {c} IS NOT NULL""")
    cte(name + "_raw", "\nUNION ALL\n".join(parts))
    cte(name, f"SELECT DISTINCT col_name, round_even(p, 2) AS threshold FROM {name}_raw")


_thresholds_cte("thr_train", "train_dev")


def _missing_long(src: str, prof_src: str) -> str:
    parts = []
    for c in C.MORTGAGE_COLUMNS:
        name = C.MISSING_INDICATOR_NAMES.get(c, f"{c} is Missing")
        parts.append(f"""SELECT Loan_Num, Month, '{name}' AS feature, CAST({_q(c)} IS NULL AS INTEGER) AS value
FROM {src} WHERE (SELECT COUNT(*) - COUNT({_q(c)}) FROM {prof_src}) > 0""")
    return "\nUNION ALL\n".join(parts)


def _category_long(src: str) -> str:
    parts = []
    for c in C.YN_COLUMNS:
        parts.append(f"SELECT Loan_Num, Month, '{c} = Yes' AS feature, "
                     f"CASE WHEN {c} = 'Y' THEN 1 ELSE 0 END AS value FROM {src}")
    for c, m in C.CATEGORICAL_MAPPINGS.items():
        for v, label in m:
            parts.append(f"SELECT Loan_Num, Month, '{c} = {label}' AS feature, "
                         f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS value FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _threshold_long(src: str, thr: str) -> str:
    parts = []
    for c in CONTINUOUS:
        parts.append(f"""SELECT s.Loan_Num, s.Month, '{c} <= ' || CAST(t.threshold AS VARCHAR) AS feature,
  CAST(s.{c} <= t.threshold AS INTEGER) AS value
FROM {src} s JOIN {thr} t ON t.col_name = '{c}'""")
    return "\nUNION ALL\n".join(parts)


cte("econ_base", """
SELECT Loan_Num, Month, First_Payment_Month, ZIP_Code, Property_State, Int_Rate, 'train' AS Set FROM train_s
UNION ALL
SELECT Loan_Num, Month, First_Payment_Month, ZIP_Code, Property_State, Int_Rate, 'test' AS Set FROM test_s
""")


def _lag(src: str, months: int) -> str:
    return f"(SELECT * REPLACE (last_day(CAST(Month + INTERVAL {months} MONTH AS DATE)) AS Month) FROM {src})"


cte("econ_joined", f"""
SELECT b.*, i.Median_Ann_Income, u.Unemp_Rate, f.Infl_Rate, h.HP_Index, ho.HP_Index AS HP_Index_Orig,
  hy.HP_Index AS HP_Index_year, r.US_30yr_FRM, ro.US_30yr_FRM AS US_30yr_FRM_Orig
FROM econ_base b
LEFT JOIN income i ON i.Month = b.Month AND i.State = b.Property_State
LEFT JOIN {_lag('unemp', 1)} u ON u.Month = b.Month AND u.ZIP_Code = b.ZIP_Code
LEFT JOIN {_lag('infl', 1)} f ON f.Month = b.Month
LEFT JOIN {_lag('hpi', 2)} h ON h.Month = b.Month AND h.ZIP_Code = b.ZIP_Code
LEFT JOIN {_lag('hpi', 2)} ho ON ho.Month = b.First_Payment_Month AND ho.ZIP_Code = b.ZIP_Code
LEFT JOIN {_lag('hpi', 14)} hy ON hy.Month = b.Month AND hy.ZIP_Code = b.ZIP_Code
LEFT JOIN rate r ON r.Month = b.Month
LEFT JOIN rate ro ON ro.Month = b.First_Payment_Month
""")

cte("pan_keys", "SELECT Loan_Num, Month, First_Payment_Month, ZIP_Code, Property_State FROM panel")

ORACLE: dict[str, str] = {}

LOG_COLUMNS = ["Log_UPB", "Log_Curr_UPB", "Log_Non_Int_Bear_UPB", "Log_Median_Ann_Income"]


def _sel(c: str) -> str:
    """Select item; logs reported to 9 decimals (last-bit differences between log10s)."""
    return f"round({c}, 9) AS {c}" if c in LOG_COLUMNS else _q(c)

ORACLE["default_rate_by_month"] = sql("""
SELECT l.Month, COUNT(*) AS n_loans, CAST(SUM(l."Default") AS BIGINT) AS n_default,
  CAST(SUM(l."Default") AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS default_rate
FROM labelled l JOIN orig o ON o.Loan_Num = l.Loan_Num GROUP BY l.Month""", "labelled", "orig")

ORACLE["scan_origination"] = sql("SELECT * EXCLUDE (Year, Quarter) FROM orig_raw", "orig_raw")

ORACLE["scan_performance"] = sql(
    "SELECT *, " + ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in PERF_NULL_COLS.items()) + " FROM perf_raw",
    "perf_raw")

ORACLE["month_end"] = sql("""
SELECT DISTINCT Month AS month_raw, last_day(CAST(strptime(Month, '%Y%m') AS DATE)) AS Month FROM perf_raw""",
                          "perf_raw")

ORACLE["clean_origination"] = sql("SELECT * FROM orig", "orig")

ORACLE["clean_performance"] = sql("""
SELECT Loan_Num, Month, Current_Actual_UPB, Current_Delinquency_Status, Loan_Age, Months_to_Maturity,
  Modification_Flag, Zero_Balance_Code, ELTV, Delinquency_Disaster_Flag FROM perf""", "perf")

ORACLE["current_default"] = sql("""
SELECT Loan_Num, Month, Current_Delinquency_Status, Zero_Balance_Code, Current_Default FROM perf_cd""", "perf_cd")

ORACLE["forward_default_label"] = sql("""
SELECT Loan_Num, Month, Current_Default, "Default" FROM fwd WHERE n_next = 12""", "fwd")

ORACLE["trailing_features"] = sql("""
SELECT Loan_Num, Month, "Default", Max_Delinq_Severity_yoy, Num_Modifications_yoy, Delinq_Status_0_Count,
  Delinq_Status_1_Count, Delinq_Status_2_Count FROM labelled""", "labelled")

ORACLE["drop_defective"] = sql("""
SELECT Loan_Num, COUNT(*) AS n_months FROM perf
WHERE Loan_Num IN (SELECT Loan_Num FROM orig)
  AND Loan_Num NOT IN (SELECT Loan_Num FROM perf WHERE Zero_Balance_Code = '96')
GROUP BY Loan_Num""", "perf", "orig")

ORACLE["distinct_loans"] = sql("SELECT DISTINCT Loan_Num FROM perf WHERE Zero_Balance_Code = '96'", "perf")

ORACLE["semi_join_loans"] = sql("""
SELECT Loan_Num, Month, Current_Actual_UPB FROM perf
WHERE Loan_Num IN (SELECT Loan_Num FROM orig WHERE Quarter = 1)""", "perf", "orig")

ORACLE["panel_join"] = sql("""
SELECT l.Loan_Num, l.Month, l."Default", o.UPB, o.ZIP_Code, o.Property_State, o.Year, o.Quarter
FROM labelled l JOIN orig o ON o.Loan_Num = l.Loan_Num""", "labelled", "orig")

ORACLE["loan_ratios"] = sql(
    "SELECT Loan_Num, Month, Payment_Ratio, Balance_Per_Month, Maturity_Progress FROM panel", "panel")

ORACLE["log_money"] = sql(
    "SELECT Loan_Num, Month, round(Log_UPB, 9) AS Log_UPB, round(Log_Curr_UPB, 9) AS Log_Curr_UPB, "
    "round(Log_Non_Int_Bear_UPB, 9) AS Log_Non_Int_Bear_UPB FROM panel", "panel")

ORACLE["zip_default_rate"] = sql(
    "SELECT DISTINCT Year, Quarter, ZIP_Code, Month, ZIP_Default_Rate FROM panel", "panel")

ORACLE["signed_target"] = sql('SELECT Loan_Num, Month, "Default" FROM panel', "panel")

_PANEL_COLS = [
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
ORACLE["build_panel"] = sql("SELECT " + ", ".join(_sel(c) for c in _PANEL_COLS) + " FROM panel", "panel")

ORACLE["income_series"] = sql("SELECT State, Month, Median_Ann_Income FROM income", "income")
ORACLE["unemployment_series"] = sql("SELECT Month, ZIP_Code, Unemp_Rate FROM unemp", "unemp")
ORACLE["inflation_series"] = sql("SELECT Month, Infl_Rate FROM infl", "infl")
ORACLE["hpi_series"] = sql("SELECT ZIP_Code, Month, HP_Index FROM hpi", "hpi")
ORACLE["rate_series"] = sql("SELECT Month, US_30yr_FRM FROM rate", "rate")
ORACLE["release_lag"] = sql(f"SELECT ZIP_Code, Month, HP_Index FROM {_lag('hpi', 14)}", "hpi")

ORACLE["join_income"] = sql("""
SELECT p.Loan_Num, p.Month, p.Property_State, i.Median_Ann_Income
FROM pan_keys p LEFT JOIN income i ON i.Month = p.Month AND i.State = p.Property_State""", "pan_keys", "income")

ORACLE["join_unemployment"] = sql(f"""
SELECT p.Loan_Num, p.Month, p.ZIP_Code, u.Unemp_Rate
FROM pan_keys p LEFT JOIN {_lag('unemp', 1)} u ON u.Month = p.Month AND u.ZIP_Code = p.ZIP_Code""",
                                   "pan_keys", "unemp")

ORACLE["join_inflation"] = sql(f"""
SELECT p.Loan_Num, p.Month, f.Infl_Rate FROM pan_keys p LEFT JOIN {_lag('infl', 1)} f ON f.Month = p.Month""",
                                "pan_keys", "infl")

ORACLE["join_hpi"] = sql(f"""
SELECT p.Loan_Num, p.Month, p.ZIP_Code, h.HP_Index, ho.HP_Index AS HP_Index_Orig, hy.HP_Index AS HP_Index_year
FROM pan_keys p
LEFT JOIN {_lag('hpi', 2)} h ON h.Month = p.Month AND h.ZIP_Code = p.ZIP_Code
LEFT JOIN {_lag('hpi', 2)} ho ON ho.Month = p.First_Payment_Month AND ho.ZIP_Code = p.ZIP_Code
LEFT JOIN {_lag('hpi', 14)} hy ON hy.Month = p.Month AND hy.ZIP_Code = p.ZIP_Code""", "pan_keys", "hpi")

ORACLE["join_rate"] = sql("""
SELECT p.Loan_Num, p.Month, r.US_30yr_FRM, ro.US_30yr_FRM AS US_30yr_FRM_Orig
FROM pan_keys p LEFT JOIN rate r ON r.Month = p.Month LEFT JOIN rate ro ON ro.Month = p.First_Payment_Month""",
                           "pan_keys", "rate")

ORACLE["econ_enrichment"] = sql("""
SELECT Loan_Num, Month, Set, Unemp_Rate, round(log10(Median_Ann_Income + 1), 9) AS Log_Median_Ann_Income, Infl_Rate,
  US_30yr_FRM, US_30yr_FRM_Orig, HP_Index / HP_Index_Orig - 1 AS HPI_Change_Orig,
  HP_Index / HP_Index_year - 1 AS HPI_Change_yoy, Int_Rate - US_30yr_FRM_Orig AS Int_Rate_Diff,
  Int_Rate - US_30yr_FRM AS Curr_Int_Rate_Diff
FROM econ_joined""", "econ_joined")

ORACLE["obs_dates"] = sql(f"""
SELECT Loan_Num, Month, Year, Quarter, Current_Delinquency_Status, Zero_Balance_Code FROM panel
WHERE Month IN ({_month_list(TRAIN_DATES + TEST_DATES)})""", "panel")

ORACLE["performing_loans"] = sql(
    "SELECT Loan_Num, Month, Year, Quarter, Current_Delinquency_Status FROM obs", "obs")

ORACLE["stratified_sample"] = sql('SELECT Loan_Num, Month, Year, Quarter, "Default" FROM train_s', "train_s")
ORACLE["test_sample"] = sql('SELECT Loan_Num, Month, Year, Quarter, "Default" FROM test_s', "test_s")

ORACLE["train_test_split"] = sql(f"""
SELECT Loan_Num, Month, 'train' AS Set FROM (
  SELECT *, row_number() OVER (PARTITION BY Month
      ORDER BY md5(concat_ws('|', Loan_Num, CAST(Month AS VARCHAR), '{SEED}')), Loan_Num) AS rn
  FROM panel WHERE Month IN ({_month_list(TRAIN_DATES)})
    AND Zero_Balance_Code IS NULL AND Current_Delinquency_Status IN ('0', '1', '2')) WHERE rn <= {N_SPLIT}
UNION ALL
SELECT Loan_Num, Month, 'test' AS Set FROM panel WHERE Month IN ({_month_list(TEST_DATES)})
  AND Zero_Balance_Code IS NULL AND Current_Delinquency_Status IN ('0', '1', '2')""", "panel")

ORACLE["union_samples"] = sql("""
SELECT Loan_Num, Month, Year, Quarter, 'train' AS Set FROM train_s
UNION ALL SELECT Loan_Num, Month, Year, Quarter, 'test' AS Set FROM test_s""", "train_s", "test_s")

ORACLE["feature_projection"] = sql("SELECT " + ", ".join(_sel(c) for c in C.MORTGAGE_COLUMNS) + " FROM train_dev",
                                   "train_dev")

ORACLE["null_profile"] = sql("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, COUNT(*) - COUNT({_q(c)}) AS null_count FROM train_dev" for c in C.MORTGAGE_COLUMNS)
    + ") WHERE null_count > 0", "train_dev")

ORACLE["percentile_thresholds"] = sql("SELECT col_name, threshold FROM thr_train", "thr_train")

ORACLE["missing_indicators"] = sql(_missing_long("train_dev", "train_dev"), "train_dev")
ORACLE["category_encoding"] = sql(_category_long("train_dev"), "train_dev")
ORACLE["threshold_encoding"] = sql(_threshold_long("train_dev", "thr_train"), "train_dev", "thr_train")
ORACLE["binary_encoding"] = sql(
    _missing_long("test_dev", "train_dev") + "\nUNION ALL\n" + _category_long("test_dev") + "\nUNION ALL\n"
    + _threshold_long("test_dev", "thr_train"), "test_dev", "train_dev", "thr_train")

ORACLE["thermometer_vectors"] = "SELECT * FROM (" + ORACLE["binary_encoding"] + ") b WHERE value = 1"

ORACLE["class_weights"] = sql("""
SELECT label, CAST(tot AS DOUBLE) / CAST(k * nc AS DOUBLE) AS weight, nc AS n FROM (
  SELECT label, COUNT(*) AS nc, SUM(COUNT(*)) OVER () AS tot, COUNT(*) OVER () AS k FROM (
    SELECT CASE WHEN "Default" = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM train_dev) GROUP BY label)""",
                               "train_dev")

ORACLE["quarter_spine"] = sql("""
SELECT CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter FROM (
  SELECT unnest(generate_series(date_trunc('quarter', min(Month)), date_trunc('quarter', max(Month)),
                                INTERVAL 3 MONTH)) AS d FROM perf)""", "perf")

ORACLE["missing_quarters"] = sql("""
SELECT * FROM (
  SELECT CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter FROM (
    SELECT unnest(generate_series(date_trunc('quarter', min(Month)), date_trunc('quarter', max(Month)),
                                  INTERVAL 3 MONTH)) AS d FROM perf)) s
WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE year(p.Month) = s.Year AND quarter(p.Month) = s.Quarter)""",
                                  "perf", "panel")

ORACLE["scan_processed"] = sql("""
SELECT Loan_Num, Month, Year, Quarter, "Default", ZIP_Default_Rate FROM panel WHERE Year = 2015 AND Quarter = 2""",
                                "panel")

ORACLE["ingest_archives"] = ORACLE["scan_performance"]

ORACLE["incremental_process"] = sql("""
SELECT Loan_Num, Month, Year, Quarter, "Default", ZIP_Default_Rate FROM panel""", "panel")

ORACLE["train_random_forest"] = sql("""
SELECT Loan_Num, Month, CASE WHEN "Default" = 1 THEN 1 ELSE 0 END AS label, 1 AS p_in_range, 1 AS consistent
FROM test_s""", "test_s")

ORACLE["train_monotone_forest"] = sql("""
SELECT Loan_Num, Month, CASE WHEN "Default" = 1 THEN 1 ELSE 0 END AS label, 1 AS p_in_range, 1 AS consistent,
  1 AS ordered
FROM test_s""", "test_s")

_FALLS = " OR ".join(f"feature LIKE '{c} <= %'" for c in C.RISK_RISES_WITH)
_RISES = " OR ".join(f"feature LIKE '{c} <= %'" for c in C.RISK_FALLS_WITH)
ORACLE["monotone_splits"] = sql(
    # both classes weigh half of the rows; a missing value is -1
    f"""SELECT feature, at_most, round(pl, 6) AS p_left, round(pr, 6) AS p_right, round(gain, 6) AS gain,
  CASE WHEN gain > 1e-9 AND (at_most = -1 OR NOT (({_FALLS}) AND pr > pl OR ({_RISES}) AND pr < pl)) THEN 1 ELSE 0 END AS made
FROM (
  SELECT *, 2 * (p * (1 - p) - (l1 + l0) / (l1 + l0 + r1 + r0) * pl * (1 - pl)
    - (r1 + r0) / (l1 + l0 + r1 + r0) * pr * (1 - pr)) AS gain
  FROM (SELECT *, l1 / (l1 + l0) AS pl, r1 / (r1 + r0) AS pr, (l1 + r1) / (l1 + l0 + r1 + r0) AS p FROM (
    SELECT feature, at_most,
      sum(CASE WHEN value <= at_most AND positive THEN weight ELSE 0 END) AS l1,
      sum(CASE WHEN value <= at_most AND NOT positive THEN weight ELSE 0 END) AS l0,
      sum(CASE WHEN value > at_most AND positive THEN weight ELSE 0 END) AS r1,
      sum(CASE WHEN value > at_most AND NOT positive THEN weight ELSE 0 END) AS r0
    FROM (
      SELECT feature, coalesce(value, -1) AS value, t."Default" = 1 AS positive,
        n::DOUBLE / (2 * CASE WHEN t."Default" = 1 THEN k ELSE n - k END) AS weight
      FROM (
""" + _missing_long("train_dev", "train_dev") + "\nUNION ALL\n" + _category_long("train_dev") + "\nUNION ALL\n"
    + _threshold_long("train_dev", "thr_train") + """
      ) e JOIN train_dev t USING (Loan_Num, Month),
      (SELECT count(*) AS n, count(*) FILTER (WHERE "Default" = 1) AS k FROM train_dev) c
    ) v, (VALUES (-1), (0)) a(at_most)
    GROUP BY feature, at_most HAVING min(value) <= at_most AND max(value) > at_most
  ) s) q) g""", "train_dev", "thr_train")

ORACLE["train_sparse_additive"] = sql("""
SELECT Loan_Num, Month, CASE WHEN "Default" = 1 THEN 1 ELSE 0 END AS label, 1 AS p_in_range, 1 AS consistent,
  1 AS support_ok
FROM test_s""", "test_s")

ORACLE["sparse_screen"] = sql(
    # the best logistic model of one 0/1 feature predicts the mean label on both of its sides
    """SELECT feature, round(-sum(CASE WHEN k = 0 OR k = m THEN 0 ELSE k * ln(k / m) + (m - k) * ln(1 - k / m) END)
  / sum(m), 5) AS loss FROM (
  SELECT feature, coalesce(value, 0) AS side, count(*)::DOUBLE AS m,
    sum(CASE WHEN t."Default" = 1 THEN 1 ELSE 0 END)::DOUBLE AS k FROM (
""" + _missing_long("train_dev", "train_dev") + "\nUNION ALL\n" + _category_long("train_dev") + "\nUNION ALL\n"
    + _threshold_long("train_dev", "thr_train") + """
  ) e JOIN train_dev t USING (Loan_Num, Month) GROUP BY ALL) g GROUP BY feature""", "train_dev", "thr_train")

ORACLE["audit_archives"] = sql("""
SELECT DISTINCT 'historical_data_time_2015Q' || (CAST(Loan_Num AS BIGINT) % 4 + 1) AS archive, 1 AS is_zip,
  1 AS n_members, 0 AS broken FROM perf
UNION ALL
SELECT DISTINCT 'historical_data_2015Q' || (CAST(Loan_Num AS BIGINT) % 4 + 1), 1, 1, 0 FROM orig
UNION ALL
SELECT * FROM (VALUES ('truncated', 1, 0, 1), ('empty', 0, 0, 1), ('text', 0, 0, 1)) v""", "perf", "orig")

ORACLE["ingest_origination"] = sql("SELECT * FROM orig_raw", "orig_raw")

ORACLE["incremental_by_file"] = ORACLE["incremental_process"]

ORACLE["written_sets"] = f'SELECT "Loan_Num", "Month", "Set" FROM ({ORACLE["union_samples"]}) s'
ORACLE["landed_performance"] = ORACLE["ingest_archives"]
ORACLE["landed_origination"] = ORACLE["ingest_origination"]
