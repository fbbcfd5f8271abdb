"""Zip archives of loan-level text files: ingest and audit.

An archive is not splittable, so each one is read by one task that streams its
member in chunks of a few MB (constant memory, any archive size). Arrow splits the chunks
into lines and Spark's CSV parser (``from_csv``) parses these with the explicit schema.
Files are opened through ``pyarrow.fs`` so the same code reads local, HDFS or
object-store paths. Python here is per-file I/O only; everything after the lines
are produced is DataFrame code.
"""

from __future__ import annotations

import contextlib
import io
import re
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
ZIP_MAGIC = b"PK\x03\x04"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: that of the cluster's default filesystem where it names
    none, so driver and executors mean the same folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _filesystem(path: str):
    """(filesystem, path inside it) of a qualified path."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    filesystem, inner = _filesystem(path)
    return filesystem.open_input_file(inner)


def _line_batch(path: str, member: str, text: bytes) -> pa.RecordBatch:
    """The lines of ``text``, ended by LF or CRLF."""
    value = pc.utf8_rtrim(pc.split_pattern(pa.array([text.decode("utf-8")]), "\n").flatten(), characters="\r")
    return pa.RecordBatch.from_arrays([pa.repeat(path, len(value)), pa.repeat(member, len(value)), value],
                                      names=["path", "member", "value"])


def _lines(batches, member_pattern: str, chunk_bytes: int = CHUNK_BYTES):
    rx = re.compile(member_pattern)
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with _open(path) as fh, zipfile.ZipFile(fh) as zf:
                for name in filter(rx.search, zf.namelist()):
                    with zf.open(name) as member:
                        rest = b""
                        while chunk := member.read(chunk_bytes):
                            whole, end, rest = (rest + chunk).rpartition(b"\n")
                            if end:
                                yield _line_batch(path, name, whole)
                        if rest:
                            yield _line_batch(path, name, rest)


def archive_paths(spark: SparkSession, pattern) -> DataFrame:
    """One row per archive file (content not read: binaryFile prunes it), one partition per
    file: the count comes from the listing, so AQE leaves it alone. ``pattern`` is a path, a
    glob, a list of them or a frame with a ``path`` column."""
    if isinstance(pattern, DataFrame):
        files = pattern
    else:
        paths = [pattern] if isinstance(pattern, str) else list(pattern)
        files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return files.repartitionByRange(max(1, files.count()), "path")


def ingest_archives(spark: SparkSession, pattern, schema, member_pattern: str = r"\.txt$") -> DataFrame:
    """Rows of every member matching ``member_pattern`` (regex) in the archives matching
    ``pattern``, parsed with ``schema`` (``|`` separated, no header, FAILFAST)."""
    paths = archive_paths(spark, pattern).select("path")
    lines = paths.mapInArrow(lambda it: _lines(it, member_pattern), "path string, member string, value string")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select(F.from_csv("value", ddl, {"sep": "|", "mode": "FAILFAST"}).alias("r"), "member")
    return parsed.select("r.*", "member")


def _audit(batches):
    for pdf in batches:
        out = []
        for path, length in zip(pdf["path"], pdf["length"]):
            rec = {"path": path, "length": int(length), "is_zip": False, "n_members": 0, "error": None}
            try:
                with _open(path) as fh:
                    rec["is_zip"] = fh.read(4) == ZIP_MAGIC
                    fh.seek(0)
                    if not rec["is_zip"]:
                        rec["error"] = "not a zip file (wrong leading bytes)"
                    else:
                        with zipfile.ZipFile(fh) as zf:
                            rec["n_members"] = len(zf.namelist())
                            if rec["n_members"] == 0:
                                rec["error"] = "archive without members"
            except Exception as e:  # noqa: BLE001 - reported per file
                rec["error"] = f"{type(e).__name__}: {e}"
            out.append(rec)
        yield pd.DataFrame(out, columns=["path", "length", "is_zip", "n_members", "error"])


def audit_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """Per archive: zip signature, readable directory, member count, error text."""
    return archive_paths(spark, pattern).mapInPandas(
        _audit, "path string, length long, is_zip boolean, n_members int, error string")


def _write_zips(batches, out_dir: str):
    """One archive per key and task: rows come sorted by key, so one file is open at a
    time and lines are streamed into it. File names depend only on the partition number,
    so a retried or speculative task attempt overwrites its own files instead of adding
    duplicates."""
    from pyspark import TaskContext
    pid = TaskContext.get().partitionId()
    now, out = None, None
    with contextlib.ExitStack() as files:
        for pdf in batches:
            for key, part in pdf.groupby(["archive", "member"], sort=False):
                if key != now:
                    files.close()
                    now = key
                    filesystem, inner = _filesystem(f"{out_dir}/{key[0]}-{key[1]}-p{pid:05d}.zip")
                    zf = files.enter_context(zipfile.ZipFile(
                        files.enter_context(filesystem.open_output_stream(inner)), "w", zipfile.ZIP_DEFLATED))
                    out = files.enter_context(zf.open(f"{key[1]}.txt", "w", force_zip64=True))
                out.write(("\n".join(part["line"]) + "\n").encode("utf-8"))
            yield pd.DataFrame({"n": [len(pdf)]})


def write_archives(df: DataFrame, out_dir: str, archive_col: str, member_col: str) -> int:
    """Write ``df`` as ``|``-separated lines into zip archives named by ``archive_col``,
    holding members named by ``member_col`` (one archive per key and partition). Keys must
    not be null."""
    out_dir = qualified(df.sparkSession, out_dir).rstrip("/")
    filesystem, inner = _filesystem(out_dir)
    filesystem.create_dir(inner, recursive=True)
    cols = [c for c in df.columns if c not in (archive_col, member_col)]
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.raise_error(F.lit(f"null archive key in {c}")))
    lines = df.select(key(archive_col).alias("archive"), key(member_col).alias("member"), line.alias("line"))
    res = lines.sortWithinPartitions("archive", "member").mapInPandas(lambda it: _write_zips(it, out_dir), "n long")
    return int(res.agg(F.sum("n")).first()[0] or 0)


def add_broken_archives(spark: SparkSession, out_dir: str) -> None:
    """A truncated archive, one without members and a text file named .zip (for the audit)."""
    whole, none = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(whole, "w") as z:
        z.writestr("historical_data_2015Q1.txt", "x|" * 500)
    zipfile.ZipFile(none, "w").close()
    for name, body in (("truncated", whole.getvalue()[:300]), ("empty", none.getvalue()), ("text", b"no archive")):
        filesystem, inner = _filesystem(f"{qualified(spark, out_dir).rstrip('/')}/{name}.zip")
        with filesystem.open_output_stream(inner) as f:
            f.write(body)


def vintage_of(member: str = "member"):
    """(Year, Quarter) parsed from a member name such as ``..._2015Q3.txt``."""
    return {"Year": F.regexp_extract(F.col(member), r"(\d{4})Q(\d)", 1).cast("int"),
            "Quarter": F.regexp_extract(F.col(member), r"(\d{4})Q(\d)", 2).cast("int")}


def ingest_loan_archives(spark: SparkSession, pattern):
    """Origination and performance rows of the archives, each tagged with the vintage
    taken from its member name (``historical_data_YYYYQn.txt`` /
    ``historical_data_time_YYYYQn.txt``)."""
    from .schemas import ORIGINATION_SCHEMA, PERFORMANCE_SCHEMA
    orig = ingest_archives(spark, pattern, ORIGINATION_SCHEMA, r"historical_data_\d{4}Q\d\.txt$")
    orig = orig.withColumns(vintage_of()).drop("member")
    perf = ingest_archives(spark, pattern, PERFORMANCE_SCHEMA, r"historical_data_time_\d{4}Q\d\.txt$")
    perf = perf.withColumns(vintage_of()).drop("member")
    return orig, perf
