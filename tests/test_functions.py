import datetime as dt
import math

from pyspark.sql import functions as F

from panelforge.functions import (feb28_after_leap, month_end, release_lag, rint2, safe_div,
                                  status_severity, severity_status, zero_pad, zip3, period_to_month,
                                  quarter_end)


def test_month_end_and_lag(spark):
    df = spark.createDataFrame([("201502",), ("201612",)], "m string")
    r = df.select(month_end("m").alias("e")).select("e", release_lag("e", 14).alias("l")).collect()
    assert [x.e for x in r] == [dt.date(2015, 2, 28), dt.date(2016, 12, 31)]
    assert [x.l for x in r] == [dt.date(2016, 4, 30), dt.date(2018, 2, 28)]
    r = df.select(month_end(F.lit("2015-06"), "yyyy-MM").alias("e")).first()
    assert r.e == dt.date(2015, 6, 30)


def test_safe_div_ieee(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (3.0, 2.0)], "a double, b double")
    out = [r[0] for r in df.select(safe_div("a", "b")).collect()]
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2])
    assert out[3] is None and out[4] == 1.5


def test_rint2_matches_numpy(spark):
    import numpy as np
    xs = [0.575, 2.675, 1.005, 0.125, 12.345, -0.575]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(rint2("x")).collect()]
    assert got == [float(v) for v in np.round(np.array(xs), 2)]


def test_codes(spark):
    df = spark.createDataFrame([("12345", 7, "RA"), ("00", 1234, "3"), (None, None, None)],
                               "z string, n long, s string")
    r = df.select(zip3("z"), zero_pad("n", 3), status_severity("s").alias("v")).collect()
    assert [x[0] for x in r] == ["123", "00", None]
    assert [x[1] for x in r] == ["007", "1234", None]
    assert [x.v for x in r] == [999, 3, None]
    assert [x[0] for x in df.select(severity_status(status_severity("s"))).collect()] == ["RA", "3", None]


def test_leap_and_periods(spark):
    df = spark.createDataFrame([(dt.date(2021, 2, 28),), (dt.date(2020, 2, 29),), (dt.date(2019, 2, 28),)], "d date")
    assert [r[0] for r in df.select(feb28_after_leap("d")).collect()] == [True, False, False]
    p = spark.createDataFrame([(2015, "M02"), (2015, "S01"), (2015, "M13")], "y long, p string")
    assert [r[0] for r in p.select(period_to_month("y", "p")).collect()] == [dt.date(2015, 2, 28), None, None]
    q = spark.createDataFrame([(2015, 3)], "y long, q long").select(quarter_end("y", "q")).first()[0]
    assert q == dt.date(2015, 9, 30)
