"""The archive data source: partitions, pushed filters, opens, streams, odd archives."""

import zipfile

import pytest

from panelforge.sources import archive_source as AS
from panelforge.sources import archives
from panelforge.sources.schemas import ORIGINATION_SCHEMA, PERFORMANCE_SCHEMA


def _row(schema, loan, **values):
    return "|".join(str({"Loan_Num": loan, **values}.get(f.name, "")) for f in schema.fields)


def _archive(folder, vintage, loans, months=3, name=None):
    with zipfile.ZipFile(f"{folder}/{name or f'historical_data_{vintage}'}.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(f"historical_data_{vintage}.txt",
                   "\n".join(_row(ORIGINATION_SCHEMA, x, Credit_Score=700) for x in loans) + "\n")
        z.writestr(f"historical_data_time_{vintage}.txt",
                   "\r\n".join(_row(PERFORMANCE_SCHEMA, x, Month=f"2016{m:02d}") for x in loans
                               for m in range(1, months + 1)))
        z.writestr("readme.md", "not a loan member")


@pytest.fixture
def folder(tmpdir_path):
    _archive(tmpdir_path, "2015Q1", ["A", "B"])
    _archive(tmpdir_path, "2015Q2", ["C"])
    _archive(tmpdir_path, "2016Q1", ["D"])
    with open(tmpdir_path + "/notes.txt", "w") as f:
        f.write("no archive")
    return tmpdir_path


def _opens(monkeypatch):
    seen, real = [], archives._open
    monkeypatch.setattr(archives, "_open", lambda p: (seen.append(p.rsplit("_", 1)[-1]), real(p))[1])
    return seen


def test_filters_skip_archives_and_members(folder, monkeypatch):
    seen = _opens(monkeypatch)
    r = AS.ArchiveReader("file:" + folder, AS.Wanted.of({"kinds": "performance", "quarters": "2015Q2,2016Q4"}))
    parts = r.partitions()
    assert seen == ["2015Q2.zip"]                                # one directory read of three
    assert [(p.kind, p.Year, p.Quarter, p.member) for p in parts] == [
        ("performance", 2015, 2, "historical_data_time_2015Q2.txt")]
    assert sum(b.num_rows for p in parts for b in r.read(p)) == 3
    assert seen == ["2015Q2.zip"] * 2


def test_one_partition_a_member_and_each_is_read_once(folder, monkeypatch):
    r = AS.ArchiveReader("file:" + folder)
    parts = r.partitions()
    assert len(parts) == len(set(parts)) == 6
    seen = _opens(monkeypatch)
    lines = [b for p in parts for b in AS.read_member(p, chunk_bytes=7)]
    assert len(seen) == 6 and sum(b.num_rows for b in lines) == 4 + 12
    assert not any("\r" in x for b in lines for x in b.column("line").to_pylist())


def test_filters_reach_the_source(spark, folder):
    with open(folder + "/historical_data_2017Q1.zip", "wb") as f:
        f.write(b"broken")
    got = AS.archive_lines(spark, folder, ["performance"], [(2015, 1), (2015, 2)])
    assert got.rdd.getNumPartitions() == 2
    assert {(r.Year, r.Quarter, r["count"]) for r in got.groupBy("Year", "Quarter").count().collect()} == {
        (2015, 1, 6), (2015, 2, 3)}
    assert got.where("Quarter = 2").count() == 3 and got.count() == 9   # no query narrows the frame for the next
    with pytest.raises(Exception, match="not a zip file"):        # without the filter it is opened
        AS.archive_lines(spark, folder).count()


def test_both_tables_of_one_pass_equal_the_two_scans(spark, folder):
    got = AS.land_archives(spark, folder)
    want = archives.ingest_loan_archives(spark, folder + "/*.zip")
    for a, b in zip(got, want):
        assert a.columns == b.columns and a.count() == b.count()
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    orig, perf = AS.land_archives(spark, folder, quarters=[(2016, 1)])
    assert [r.Loan_Num for r in orig.collect()] == ["D"] and perf.count() == 3


def test_streams_read_every_archive_once(spark, folder):
    out, ckpt = folder + "/landed", folder + "/ckpt"
    count = lambda: [t.count() for t in AS.landed(spark, out)]
    AS.land_new_archives(spark, folder, out, ckpt)
    assert count() == [4, 12]
    AS.land_new_archives(spark, folder, out, ckpt)               # nothing new
    assert count() == [4, 12]
    _archive(folder, "2014Q4", ["Z"])
    import os
    os.utime(folder + "/historical_data_2014Q4.zip", (1, 1))     # late, with an old time stamp
    AS.land_new_archives(spark, folder, out, ckpt)
    assert count() == [5, 15]


def test_odd_archives(spark, tmpdir_path):
    lines = lambda: AS.archive_lines(spark, tmpdir_path)
    assert lines().count() == 0                                  # an empty folder
    _archive(tmpdir_path, "2015Q3", [], name="part-a")           # no vintage in its name, members without lines
    assert [r.line for r in lines().collect()] == [""]           # the lone line end of the origination member
    _archive(tmpdir_path, "2015Q3", ["A"], name="historical_data_2015Q4")
    with pytest.raises(Exception, match="another vintage"):
        lines().count()
    zipfile.ZipFile(tmpdir_path + "/none.zip", "w").close()
    with pytest.raises(ValueError, match="not a zip file with members"):
        AS.members_of("file:" + tmpdir_path + "/none.zip")
