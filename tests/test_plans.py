"""Physical-plan checks: the shapes the engine relies on at scale."""

import re

from panelforge.operators.panel import build_panel, label_and_lookback
from panelforge.plans import pipeline as PL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_label_and_lookback_one_exchange_one_window(spark):
    _, perf = PL.loan_tables(spark, "/root/testdata/sf0.001")
    p = _plan(label_and_lookback(perf))
    loan_exchanges = re.findall(r"Exchange hashpartitioning\(Loan_Num#\d+", p)
    assert len(loan_exchanges) == 1, p
    assert p.count("Window [") == 1, p          # W1-W6 and the defect flag share one Window node
    # 28 Feb after a leap year costs a frame of one month, not a second one of 13
    assert "RangeFrame, -12, -12" in p and "RangeFrame, -12, currentrow" not in p, p


def test_panel_plan_shape(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # cluster-size tables: no planner broadcast
    try:
        orig, perf = PL.loan_tables(spark, "/root/testdata/sf0.001")
        p = _plan(build_panel(orig, perf))
        # the labelled panel is written once: nothing behind it shuffles by loan again
        assert not re.findall(r"Exchange hashpartitioning\(Loan_Num#\d+", p), p
        assert "SortMergeJoin" in p and "/labelled-panel-" in p
        # the origination join reuses the loan partitioning of the window: one loan shuffle per side
        joined = _plan(label_and_lookback(perf).join(orig.select("Loan_Num", "UPB"), "Loan_Num"))
        assert len(re.findall(r"Exchange hashpartitioning\(Loan_Num#\d+", joined)) == 2, joined
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rates_join_leaves_the_panel_where_it_is(spark):
    """The rates' size is known to the planner, whatever the panel's size."""
    from pyspark.sql import functions as F
    from panelforge.operators.panel import zip_default_rate
    panel = spark.range(40000).selectExpr(
        "2015 Year", "1 Quarter", "cast(id % 3 as string) ZIP_Code", "last_day(add_months(date'2016-01-31', cast(id % 30 as int))) Month",
        "cast(id % 2 as int) Default", "uuid() wide")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")  # less than the panel, more than the rates
    try:
        p = _plan(zip_default_rate(panel))
        assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p, p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_raw_performance_is_shuffled_by_loan_once(spark):
    _, perf = PL.loan_tables(spark, "/root/testdata/sf0.001")
    assert _plan(label_and_lookback(perf)).count("Exchange ") == 1


def test_processed_table_partition_pruning(spark, tmpdir_path):
    orig, perf = PL.loan_tables(spark, "/root/testdata/sf0.001")
    PL.run_process(spark, orig, perf, tmpdir_path + "/processed")
    df = PL.read_processed(spark, tmpdir_path + "/processed", [(2015, 2)])
    p = _plan(df)
    assert "PartitionFilters: [isnotnull(Year" in p and "(Quarter#" in p
    assert {tuple(r) for r in df.select("Year", "Quarter").distinct().collect()} <= {(2015, 2)}
    # re-running one vintage rewrites only that partition
    PL.run_process(spark, orig, perf, tmpdir_path + "/processed", quarters=[(2015, 1)])
    all_q = {r.Quarter for r in spark.read.parquet(tmpdir_path + "/processed").select("Quarter").distinct().collect()}
    assert all_q == {1, 2, 3, 4}


def test_one_vintage_prunes_the_performance_rows(spark, tmpdir_path):
    """Vintage on the performance side and not a function of the loan id: both sides are
    filtered before the loan shuffle, and a vintage is written to few files."""
    from pyspark.sql import functions as F
    orig, perf = PL.loan_tables(spark, "/root/testdata/sf0.001")
    orig = orig.withColumn("Quarter", (F.abs(F.hash("Loan_Num")) % 4 + 1).cast("int"))
    perf = perf.join(orig.select("Loan_Num", "Year", "Quarter"), "Loan_Num")
    perf.write.parquet(tmpdir_path + "/perf")
    out = tmpdir_path + "/processed"
    PL.run_process(spark, orig, spark.read.parquet(tmpdir_path + "/perf"), out, quarters=[(2015, 3)])
    got = spark.read.parquet(out)
    assert {tuple(r) for r in got.select("Year", "Quarter").distinct().collect()} == {(2015, 3)}
    assert len(got.inputFiles()) <= 4
    exp = build_panel(orig.where("Quarter = 3"), perf.drop("Year", "Quarter")).select("Loan_Num", "Month", "ZIP_Default_Rate")
    assert got.select(exp.columns).exceptAll(exp).count() == 0 and got.count() == exp.count()


def test_no_sample_of_zero_rows(spark):
    import pytest
    from panelforge.operators.sampling import stratified_sample
    with pytest.raises(ValueError):
        stratified_sample(spark.range(10), ["id"], 0)
