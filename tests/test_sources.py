import pytest
from pyspark.sql import functions as F

from panelforge.sources import quarters as QS
from panelforge.sources import text as TX
from panelforge.sources.archives import audit_archives, ingest_loan_archives, write_archives
from panelforge.sources.schemas import ORIGINATION_SCHEMA, PERFORMANCE_SCHEMA


def test_quarters_list_modes():
    assert QS.quarters_list("start_end", (2015, 3), (2016, 2)) == [(2015, 3), (2015, 4), (2016, 1), (2016, 2)]
    assert QS.quarters_list("list", listed=[[2015, 1]]) == [(2015, 1)]
    with pytest.raises(ValueError):
        QS.quarters_list("bogus")


def test_spine_and_missing(spark):
    sp = QS.quarter_spine(spark, (2015, 3), (2016, 2))
    assert [tuple(r) for r in sp.collect()] == [(2015, 3), (2015, 4), (2016, 1), (2016, 2)]
    have = spark.createDataFrame([(2015, 4, 1)], "Year int, Quarter int, x int")
    assert sorted(tuple(r) for r in QS.missing_quarters(sp, have).collect()) == [(2015, 3), (2016, 1), (2016, 2)]


def test_pipe_text_roundtrip(spark, tmpdir_path):
    row = tuple(None for _ in PERFORMANCE_SCHEMA.fields)
    df = spark.createDataFrame([("L1", "201501", 1.5) + row[3:]], PERFORMANCE_SCHEMA)
    TX.write_pipe_text(df, tmpdir_path + "/p")
    back = TX.scan_performance(spark, tmpdir_path + "/p").collect()
    assert back[0].Loan_Num == "L1" and back[0].Current_Actual_UPB == 1.5 and back[0].ELTV is None


def test_archives_roundtrip_and_audit(spark, tmpdir_path):
    o = tuple(None for _ in ORIGINATION_SCHEMA.fields)
    names = [f.name for f in ORIGINATION_SCHEMA.fields]
    orow = list(o)
    orow[names.index("Loan_Num")] = "L1"
    orow[names.index("Credit_Score")] = 700
    orig = spark.createDataFrame([tuple(orow)], ORIGINATION_SCHEMA)
    perf = spark.createDataFrame([("L1", f"2015{m:02d}", 1.0) + tuple(None for _ in PERFORMANCE_SCHEMA.fields)[3:]
                                  for m in range(1, 13)], PERFORMANCE_SCHEMA)
    out = tmpdir_path + "/zips"
    write_archives(orig.withColumns({"_a": F.lit("historical_data_2015Q1"), "_m": F.lit("historical_data_2015Q1")}),
                   out, "_a", "_m")
    write_archives(perf.withColumns({"_a": F.lit("historical_data_2015Q1"),
                                     "_m": F.lit("historical_data_time_2015Q1")}), out, "_a", "_m")
    with open(out + "/broken.zip", "wb") as f:
        f.write(b"not a zip")
    o2, p2 = ingest_loan_archives(spark, out + "/historical*.zip")
    r = o2.first()
    assert (r.Loan_Num, r.Credit_Score, r.Year, r.Quarter) == ("L1", 700, 2015, 1)
    assert p2.count() == 12
    audit = {r.path.rsplit("/", 1)[-1]: r for r in audit_archives(spark, out + "/*.zip").collect()}
    assert audit["broken.zip"].is_zip is False and audit["broken.zip"].error
    assert all(r.is_zip and r.n_members == 1 for k, r in audit.items() if k != "broken.zip")


def test_lines_across_chunks(tmpdir_path):
    """Lines cut by chunk borders, CRLF, blank lines, wide characters, no final line end."""
    import zipfile

    import pyarrow as pa

    from panelforge.sources.archives import _lines
    lines = ["a|1", "", "größe|" + "x" * 40, "δ|2", "end"]
    with zipfile.ZipFile(tmpdir_path + "/a.zip", "w") as z:
        z.writestr("one.txt", "\r\n".join(lines))
        z.writestr("two.txt", "\n".join(lines) + "\n")
        z.writestr("none.txt", "")
        z.writestr("skip.csv", "no")
    paths = pa.RecordBatch.from_arrays([pa.array(["file:" + tmpdir_path + "/a.zip"])], names=["path"])
    for chunk in (1, 7, 1 << 20):
        got = pa.Table.from_batches(_lines([paths], r"\.txt$", chunk)).to_pydict()
        assert got["value"] == lines * 2 and got["member"] == ["one.txt"] * 5 + ["two.txt"] * 5


def test_one_archive_per_key_and_partition(spark, tmpdir_path):
    import os
    n = 30_000  # several Arrow batches per task
    df = spark.range(0, n, 1, 2).select("id", (F.col("id") % 3).cast("string").alias("_a"), F.lit("m").alias("_m"))
    assert write_archives(df, tmpdir_path + "/z", "_a", "_m") == n
    assert len([f for f in os.listdir(tmpdir_path + "/z") if f.endswith(".zip")]) == 6
    from panelforge.sources.archives import ingest_archives
    from pyspark.sql.types import LongType, StructField, StructType
    back = ingest_archives(spark, tmpdir_path + "/z/*.zip", StructType([StructField("id", LongType())]))
    assert back.agg(F.count("id"), F.countDistinct("id"), F.sum("id")).first()[:] == (n, n, n * (n - 1) // 2)
