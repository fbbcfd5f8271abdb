import datetime as dt
import hashlib

from pyspark.sql import functions as F

from panelforge.operators.sampling import (at_obs_dates, obs_month_ends, performing, stratified_sample,
                                           sample_panel, train_test_split)


def _frame(spark, n_per=(5, 40, 300)):
    rows = []
    for s, n in enumerate(n_per):
        for i in range(n):
            rows.append((str(1000 * s + i), dt.date(2021, 3, 31), 2015, s + 1))
    return spark.createDataFrame(rows, "Loan_Num string, Month date, Year int, Quarter int")


def _brute(rows, n, seed):
    by = {}
    for r in rows:
        key = (r["Year"], r["Quarter"], r["Month"])
        h = hashlib.md5(f"{r['Loan_Num']}|{r['Month'].isoformat()}|{seed}".encode()).hexdigest()
        by.setdefault(key, []).append((h, r["Loan_Num"]))
    out = set()
    for key, lst in by.items():
        for h, loan in sorted(lst)[:n]:
            out.add((loan, key[2]))
    return out


def test_sample_equals_brute_force_and_min_n(spark):
    df = _frame(spark)
    got = stratified_sample(df, ["Year", "Quarter", "Month"], 30, seed=2001, digits=1)
    rows = [r.asDict() for r in df.collect()]
    assert {(r.Loan_Num, r.Month) for r in got.collect()} == _brute(rows, 30, 2001)
    counts = {r.Quarter: r["count"] for r in got.groupBy("Quarter").count().collect()}
    assert counts == {1: 5, 2: 30, 3: 30}


def test_sample_independent_of_partitioning(spark):
    df = _frame(spark)
    a = {tuple(r) for r in stratified_sample(df, ["Year", "Quarter", "Month"], 17, seed=5).collect()}
    b = {tuple(r) for r in stratified_sample(df.repartition(7), ["Year", "Quarter", "Month"], 17, seed=5).collect()}
    assert a == b and len(a) == 5 + 17 + 17


def test_sample_none_keeps_all(spark):
    df = _frame(spark)
    assert stratified_sample(df, ["Quarter"], None).count() == df.count()


def test_obs_dates_filter_is_pushed(spark, tmpdir_path):
    df = _frame(spark).withColumn("Zero_Balance_Code", F.lit(None).cast("string")) \
        .withColumn("Current_Delinquency_Status", F.lit("0"))
    df.write.parquet(tmpdir_path + "/t")
    r = at_obs_dates(spark.read.parquet(tmpdir_path + "/t"), ["2021-03"])
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Month), EqualTo(Month,2021-03-31)]" in plan
    assert obs_month_ends(["2020-02", "2021-12"]) == [dt.date(2020, 2, 29), dt.date(2021, 12, 31)]
    train, test = sample_panel(spark.read.parquet(tmpdir_path + "/t"), ["2021-03"], ["2022-03"], 30, None,
                               seed=1, n_quarters=3)
    assert train.count() == 5 + 10 + 10 and test.count() == 0


def test_train_test_split_short_month_raises(spark):
    import pytest
    df = performing(_frame(spark).withColumn("Zero_Balance_Code", F.lit(None).cast("string"))
                    .withColumn("Current_Delinquency_Status", F.lit("0")))
    with pytest.raises(ValueError):
        train_test_split(df, ["2021-03", "2021-06"], ["2022-03"], 100)
    tr, te = train_test_split(df, ["2021-03"], ["2022-03"], 100)
    assert tr.count() == 100
