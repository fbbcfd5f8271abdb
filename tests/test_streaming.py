import pytest
from pyspark.sql import functions as F

from panelforge.operators.cleaning import clean_origination, clean_performance
from panelforge.operators.panel import build_panel
from panelforge.sources import fixtures as fx
from panelforge.sources.archives import write_archives
from panelforge.sources.archives import archive_paths
from panelforge.streaming.incremental import process_archives, process_new_archives, vintages_present

SF = "/root/testdata/sf0.001"


def _write(spark, out, quarters, where="true"):
    vq = F.concat(F.lit("2015Q"), (F.col("Loan_Num").cast("long") % 4 + 1).cast("string"))
    keep = (F.col("Loan_Num").cast("long") % 4 + 1).isin(quarters)
    orig = fx.raw_origination(spark, SF, with_vintage=False).where(keep).where(where)
    perf = fx.raw_performance(spark, SF).where(keep).where(where)
    write_archives(orig.withColumns({"_a": F.concat(F.lit("historical_data_"), vq),
                                     "_m": F.concat(F.lit("historical_data_"), vq)}), out, "_a", "_m")
    write_archives(perf.withColumns({"_a": F.concat(F.lit("historical_data_"), vq),
                                     "_m": F.concat(F.lit("historical_data_time_"), vq)}), out, "_a", "_m")


def test_incremental_processes_only_new_vintages(spark, tmpdir_path):
    arch, out, ck = tmpdir_path + "/arch", tmpdir_path + "/processed", tmpdir_path + "/ck"
    _write(spark, arch, [1, 2])
    process_new_archives(spark, arch, out, ck)
    assert [tuple(r) for r in vintages_present(spark, out).collect()] == [(2015, 1), (2015, 2)]
    _write(spark, arch, [3, 4])
    process_new_archives(spark, arch, out, ck)          # second run sees only the new archives
    assert [tuple(r) for r in vintages_present(spark, out).collect()] == [(2015, q) for q in (1, 2, 3, 4)]
    got = spark.read.parquet(out).select("Loan_Num", "Month", "Default", "ZIP_Default_Rate")
    exp = build_panel(clean_origination(fx.raw_origination(spark, SF)),
                      clean_performance(fx.raw_performance(spark, SF))) \
        .select("Loan_Num", "Month", "Default", "ZIP_Default_Rate")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def _expected(spark):
    return build_panel(clean_origination(fx.raw_origination(spark, SF)),
                       clean_performance(fx.raw_performance(spark, SF))).select("Loan_Num", "Month", "Default", "ZIP_Default_Rate")


def _same(got, exp):
    got = got.select(exp.columns)
    return got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_one_file_per_trigger_and_late_archives_lose_nothing(spark, tmpdir_path):
    arch, out, ck = tmpdir_path + "/arch", tmpdir_path + "/processed", tmpdir_path + "/ck"
    _write(spark, arch + "/a", [1, 2, 3, 4], "cast(Loan_Num as long) < 100")
    process_new_archives(spark, arch + "/*", out, ck, max_files_per_trigger=1)
    early = spark.read.parquet(out).count()
    _write(spark, arch + "/b", [1, 2, 3, 4], "cast(Loan_Num as long) >= 100")   # late parts of known vintages
    process_new_archives(spark, arch + "/*", out, ck, max_files_per_trigger=3)
    assert 0 < early < spark.read.parquet(out).count() and _same(spark.read.parquet(out), _expected(spark))


def test_archives_are_read_once_and_due_vintages_survive_a_failure(spark, tmpdir_path, monkeypatch):
    from panelforge.streaming import incremental
    arch, out, ck = tmpdir_path + "/arch", tmpdir_path + "/processed", tmpdir_path + "/ck"
    _write(spark, arch + "/a", [1, 2], "cast(Loan_Num as long) < 100")
    _write(spark, arch + "/b", [1, 2], "cast(Loan_Num as long) >= 100")
    read, whole = [], incremental._process_vintages

    def process(spark_, dir_, vintages, path):
        done = [tuple(r) for r in vintages.collect()]
        read.extend(done)
        if (2015, 2) in done and read.count((2015, 2)) == 1:
            raise RuntimeError("lost")
        whole(spark_, dir_, vintages, path)

    monkeypatch.setattr(incremental, "_process_vintages", process)
    with pytest.raises(Exception, match="lost"):
        process_new_archives(spark, arch + "/*", out, ck, max_files_per_trigger=1)
    process_new_archives(spark, arch + "/*", out, ck, max_files_per_trigger=1)
    assert read.count((2015, 1)) == 1 and read.count((2015, 2)) == 2    # eight archives and more
    exp = _expected(spark).where("cast(Loan_Num as long) % 4 < 2")
    assert _same(spark.read.parquet(out), exp)


def test_stage_control(spark, tmpdir_path):
    arch, out = tmpdir_path + "/arch", tmpdir_path + "/processed"
    _write(spark, arch, [1, 2])
    with pytest.raises(RuntimeError):
        process_archives(spark, arch, out, [(2015, 1), (2015, 3)])
    assert process_archives(spark, arch, out, [(2015, 1)]) == [(2015, 1)]
    assert process_archives(spark, arch, out, [(2015, 1), (2015, 2)]) == [(2015, 2)]
    assert process_archives(spark, arch, out, [(2015, 1), (2015, 2)]) == []
    assert process_archives(spark, arch, out, [(2015, 1)], refresh=True) == [(2015, 1)]
    assert archive_paths(spark, arch + "/*.zip").rdd.getNumPartitions() == archive_paths(spark, arch + "/*.zip").count()
