import datetime as dt

from pyspark.sql import functions as F

from panelforge.operators import economic as E
from panelforge.sources.economic import read_income


def test_gap_fill_snaps_grid_and_forward_fills(spark):
    df = spark.createDataFrame([("A", dt.date(2015, 6, 30), 1.0), ("A", dt.date(2015, 9, 30), None),
                                ("A", dt.date(2015, 10, 31), 4.0), ("B", dt.date(2015, 5, 31), 2.0)],
                               "k string, Month date, v double")
    out = {(r.k, r.Month): r.v for r in E.gap_fill(df, ["k"]).collect()}
    assert out[("A", dt.date(2015, 7, 31))] == 1.0 and out[("A", dt.date(2015, 8, 31))] == 1.0
    assert out[("A", dt.date(2015, 9, 30))] == 1.0 and out[("A", dt.date(2015, 10, 31))] == 4.0
    assert out == {**out} and ("B", dt.date(2015, 6, 30)) not in out      # no extrapolation
    assert len([k for k in out if k[0] == "A"]) == 5


def test_income_csv_with_index_column(spark, tmpdir_path):
    p = tmpdir_path + "/income.csv"
    with open(p, "w") as f:
        f.write(",Month,State,Median_Ann_Income\n0,2014-05,AL,30850\n1,2014-05,AK,45200\n2,2015-05,AL,31000\n")
    inc = E.income(read_income(spark, p))
    rows = {(r.State, r.Month): r.Median_Ann_Income for r in inc.collect()}
    assert rows[("AL", dt.date(2014, 12, 31))] == 30850.0 and rows[("AL", dt.date(2015, 5, 31))] == 31000.0
    assert len([k for k in rows if k[0] == "AL"]) == 13 and len([k for k in rows if k[0] == "AK"]) == 1


def test_inflation_drops_half_years_and_rate_last_of_month(spark):
    raw = spark.createDataFrame([(2015, "M01", 1.0), (2015, "S01", 9.0), (2015, "M13", 9.0)],
                                "Year long, Period string, Value double")
    assert [(r.Month, r.Infl_Rate) for r in E.inflation(raw).collect()] == [(dt.date(2015, 1, 31), 1.0)]
    rate = spark.createDataFrame([(dt.date(2015, 1, 8), 3.0), (dt.date(2015, 1, 29), 3.5)], "Date date, US_30yr_FRM double")
    assert [tuple(r) for r in E.mortgage_rate(rate).collect()] == [(dt.date(2015, 1, 31), 3.5)]


def test_attach_leaves_the_strategy_to_the_planner(spark):
    loans = spark.createDataFrame([(1, "m"), (2, "x")], "id int, Month string")
    ser = spark.createDataFrame([("m", 0.5)], "Month string, v double")
    plan = lambda: E.attach(loans, ser, ["Month"], ["Month"])
    assert "hint" not in plan()._jdf.queryExecution().analyzed().toString().lower()
    assert sorted((r.id, r.v) for r in plan().collect()) == [(1, 0.5), (2, None)]
