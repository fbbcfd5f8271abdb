import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelforge.operators.cleaning import clean_origination, clean_performance
from panelforge.operators.panel import (current_default, label_and_lookback, zip_default_rate,
                                        drop_defective)


def _perf(spark, rows):
    """rows: (loan, 'YYYYMM', status, zbc, mod_flag)"""
    df = spark.createDataFrame(rows, "Loan_Num string, Month string, Current_Delinquency_Status string, "
                                     "Zero_Balance_Code string, Modification_Flag string")
    return clean_performance(df)


def _months(start_y, start_m, n):
    out, y, m = [], start_y, start_m
    for _ in range(n):
        out.append(f"{y}{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def test_label_needs_twelve_following_rows(spark):
    rows = [("A", m, "0", None, None) for m in _months(2015, 1, 12)]          # 12 rows: no label
    rows += [("B", m, "0", None, None) for m in _months(2015, 1, 13)]         # 13 rows: one label
    out = label_and_lookback(_perf(spark, rows)).collect()
    assert [(r.Loan_Num, r.Month) for r in out] == [("B", dt.date(2015, 1, 31))]


def test_label_window_excludes_current_row(spark):
    ms = _months(2015, 1, 26)
    rows = [("C", m, "3" if i == 0 else "0", None, None) for i, m in enumerate(ms)]   # default only at row 0
    rows += [("D", m, "3" if i == 12 else "0", None, None) for i, m in enumerate(ms)]  # default at row 12
    rows += [("E", m, "3" if i == 13 else "0", None, None) for i, m in enumerate(ms)]  # default at row 13
    out = {(r.Loan_Num, r.Month): r.Default for r in label_and_lookback(_perf(spark, rows)).collect()}
    first = dt.date(2015, 1, 31)
    assert out[("C", first)] == 0 and out[("D", first)] == 1 and out[("E", first)] == 0


def test_current_default_is_lexical(spark):
    df = spark.createDataFrame([("10", None), ("29", None), ("30", None), ("RA", None), (None, "03"),
                                (None, None), ("2", "01")], "Current_Delinquency_Status string, Zero_Balance_Code string")
    got = [r[0] for r in df.select(current_default()).collect()]
    assert got == [0, 0, 1, 1, 1, 0, 0]


def test_trailing_counts_calendar_months_with_gap(spark):
    # 14 monthly rows, a 12-month gap, 14 more rows: the look-back after the gap sees no old rows
    ms = _months(2015, 1, 14) + _months(2017, 3, 14)
    rows = [("G", m, "1", None, "Y") for m in ms]
    out = {r.Month: r for r in label_and_lookback(_perf(spark, rows)).collect()}
    assert out[dt.date(2016, 1, 31)].Delinq_Status_1_Count == 12
    assert out[dt.date(2017, 3, 31)].Delinq_Status_1_Count == 1       # first row after the gap
    assert out[dt.date(2017, 3, 31)].Num_Modifications_yoy == 1


def test_trailing_leap_year_frame(spark):
    ms = _months(2019, 1, 40)
    rows = [("L", m, "0", None, None) for m in ms]
    res = {r.Month: r.Delinq_Status_0_Count for r in label_and_lookback(_perf(spark, rows)).collect()}
    assert res[dt.date(2020, 2, 29)] == 12        # (2019-02-28, 2020-02-29]
    assert res[dt.date(2021, 2, 28)] == 13        # (2020-02-28, 2021-02-28] holds 2020-02-29
    plain = {r.Month: r.Delinq_Status_0_Count
             for r in label_and_lookback(_perf(spark, rows), strict_calendar=False).collect()}
    assert plain[dt.date(2021, 2, 28)] == 12


def test_max_severity_ra_and_nulls(spark):
    ms = _months(2015, 1, 14)
    st = ["0", "RA", "12"] + ["0"] * 11
    rows = [("R", m, s, None, None) for m, s in zip(ms, st)]
    rows += [("N", m, None, None, None) for m in ms]
    out = {(r.Loan_Num, r.Month): r.Max_Delinq_Severity_yoy for r in label_and_lookback(_perf(spark, rows)).collect()}
    assert out[("R", dt.date(2015, 2, 28))] == "RA"
    assert out[("N", dt.date(2015, 2, 28))] is None


def test_defective_loans_dropped(spark):
    ms = _months(2015, 1, 14)
    rows = [("X", m, "0", "96" if i == 13 else None, None) for i, m in enumerate(ms)]
    rows += [("Y", m, "0", None, None) for m in ms]
    out = {r.Loan_Num for r in label_and_lookback(_perf(spark, rows)).collect()}
    assert out == {"Y"}
    orig = spark.createDataFrame([("X",), ("Y",)], "Loan_Num string")
    o, p = drop_defective(orig, _perf(spark, rows))
    assert {r.Loan_Num for r in o.collect()} == {"Y"} and p.count() == 14


def test_zip_rate_two_level_equals_naive(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for loan in range(60):
        z = rnd.choice(["001", "002", None])
        for i, m in enumerate(_months(2015, rnd.randint(1, 12), rnd.randint(3, 20))):
            rows.append((str(loan), dt.date(int(m[:4]), int(m[4:]), 1), z, rnd.randint(0, 1)))
    df = (spark.createDataFrame(rows, "Loan_Num string, d date, ZIP_Code string, Default int")
          .select("Loan_Num", F.last_day("d").alias("Month"), "ZIP_Code", "Default",
                  F.lit(2015).alias("Year"), F.lit(1).alias("Quarter")))
    got = {(r.Loan_Num, r.Month): r.ZIP_Default_Rate for r in zip_default_rate(df).collect()}
    pdf = df.toPandas()
    for (loan, month), rate in got.items():
        z = pdf[(pdf.Loan_Num == loan) & (pdf.Month == month)].ZIP_Code.iloc[0]
        lo = dt.date(month.year - 1, month.month, 28) if month.month == 2 else None
        peers = pdf[(pdf.ZIP_Code.isna()) if z is None else (pdf.ZIP_Code == z)]
        from dateutil.relativedelta import relativedelta
        start = month - relativedelta(months=12)
        win = peers[(peers.Month > start) & (peers.Month <= month)]
        assert abs(win.Default.mean() - rate) < 1e-12, (loan, month)


def test_cleaning_sentinels_and_recode(spark):
    from panelforge.sources.schemas import ORIGINATION_SCHEMA
    vals = {f.name: None for f in ORIGINATION_SCHEMA.fields}
    a = dict(vals, Loan_Num="1", ZIP_Code="00", Property_Val_Meth="9", MI_Canc_Indicator="7",
             Credit_Score=9999, First_Payment_Month="201502")
    b = dict(vals, Loan_Num="2", ZIP_Code="12345", Property_Val_Meth="R", MI_Canc_Indicator="9",
             Credit_Score=700, Sup_Conforming_Flag="Y")
    c = dict(vals, Loan_Num="3", ZIP_Code="12345", Property_Val_Meth="2")
    df = spark.createDataFrame([tuple(r[f.name] for f in ORIGINATION_SCHEMA.fields) for r in (a, b, c)],
                               ORIGINATION_SCHEMA)
    out = {r.Loan_Num: r for r in clean_origination(df).collect()}
    assert out["1"].ZIP_Code is None and out["1"].Property_Val_Meth is None
    assert out["1"].MI_Canc_Indicator is None and out["1"].Credit_Score is None
    assert out["1"].First_Payment_Month == dt.date(2015, 2, 28) and out["1"].Sup_Conforming_Flag == "N"
    assert out["2"].ZIP_Code == "123" and out["2"].Property_Val_Meth == "R" and out["2"].MI_Canc_Indicator == "9"
    assert out["3"].Property_Val_Meth == "A"


def test_zip_rate_lag_option(spark):
    rows = [("1", dt.date(2015, m, 1), "001", 1 if m == 1 else 0) for m in range(1, 13)]
    rows += [("1", dt.date(2016, m, 1), "001", 0) for m in range(1, 13)]
    df = (spark.createDataFrame(rows, "Loan_Num string, d date, ZIP_Code string, Default int")
          .select("Loan_Num", F.last_day("d").alias("Month"), "ZIP_Code", "Default",
                  F.lit(2015).alias("Year"), F.lit(1).alias("Quarter")))
    now = {r.Month: r.ZIP_Default_Rate for r in zip_default_rate(df).collect()}
    lagged = {r.Month: r.ZIP_Default_Rate for r in zip_default_rate(df, lag_months=12).collect()}
    assert lagged[dt.date(2016, 1, 31)] == now[dt.date(2015, 1, 31)] == 1.0
    assert lagged[dt.date(2015, 6, 30)] is None
