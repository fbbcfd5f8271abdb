"""Loan archives as a Python data source, for batch and streaming reads.

``spark.read.format("loan_archives").load(folder)`` gives one row per line of every loan
member of the folder's zip archives (path, member, kind, Year, Quarter, line), one
partition per member. The options ``kinds`` and ``quarters`` filter while planning: an
archive whose name carries another vintage isn't opened, and a member that they rule out
isn't read. ``land_archives`` reads every member once and gives both tables.

The filters are options and not pushed by the optimiser, since Spark 4.1 keeps what was
pushed with the loaded frame: a second query of that frame without the filter would miss
rows.

Planning reads the directories of the archives that are left (their last bytes, in
parallel threads) on the driver's host and holds one small entry per member.

The streaming reader keeps the list of archives it has seen in a folder of numbered
manifests (option ``manifest``, one folder per query); offsets are manifest numbers. An
archive is read once whenever and with whatever time stamp it arrives, and a repeated batch
reads the same archives. Archives must appear whole (by rename or upload), as for Spark's
own file source.

Defined results: files that are no ``.zip`` and members of other names are left alone;
empty members give no rows; an archive that can't be read raises an error unless the
vintage in its name is not wanted; a member whose vintage is not that of its archive's name
raises an error, since skipping relies on the name. Archives without a vintage in their name
are always opened."""

from __future__ import annotations

import json
import re
import zipfile
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import scratch_path, ship_package
from . import archives
from .schemas import ORIGINATION_SCHEMA, PERFORMANCE_SCHEMA

SCHEMA = "path string, member string, kind string, Year int, Quarter int, line string"
ARROW = pa.schema([("path", pa.string()), ("member", pa.string()), ("kind", pa.string()),
                   ("Year", pa.int32()), ("Quarter", pa.int32()), ("line", pa.string())])
# Names of the members.
MEMBER = re.compile(r"historical_data_(time_)?(\d{4})Q(\d)\.txt$")
ARCHIVE = re.compile(r"(\d{4})Q(\d)[^/]*$")
KINDS = {None: "origination", "time_": "performance"}
THREADS = 32


@dataclass(frozen=True)
class Member(InputPartition):
    path: str
    member: str
    kind: str
    Year: int
    Quarter: int


@dataclass(frozen=True)
class Wanted:
    """What to read; None: all."""
    kinds: tuple | None = None
    quarters: tuple | None = None

    @classmethod
    def of(cls, options) -> "Wanted":
        split = lambda name: tuple(options[name].split(",")) if name in options else None
        return cls(split("kinds"), split("quarters"))

    def vintage(self, year: int, quarter: int) -> bool:
        return self.quarters is None or f"{year}Q{quarter}" in self.quarters

    def kind(self, kind: str) -> bool:
        return self.kinds is None or kind in self.kinds


def list_archives(folder: str) -> list[str]:
    """Qualified paths of the folder's zip archives, in order."""
    from pyarrow import fs
    filesystem, inner = archives._filesystem(folder)
    prefix = folder[:len(folder) - len(inner)] if folder.endswith(inner) else folder.split(":", 1)[0] + ":"
    infos = filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(prefix + i.path for i in infos if i.is_file and i.path.endswith(".zip"))


def members_of(path: str, wanted: Wanted = Wanted()) -> list[Member]:
    """The wanted loan members of one archive; reads its directory only."""
    named = ARCHIVE.search(path)
    if named and not wanted.vintage(int(named[1]), int(named[2])):
        return []
    try:
        with archives._open(path) as fh, zipfile.ZipFile(fh) as zf:
            names = zf.namelist()
    except (zipfile.BadZipFile, pa.ArrowInvalid) as e:  # the latter: shorter than any directory
        raise ValueError(f"{path} is not a zip file with members (see audit_archives)") from e
    out = []
    for name in names:
        if found := MEMBER.search(name):
            m = Member(path, name, KINDS[found[1]], int(found[2]), int(found[3]))
            if named and (m.Year, m.Quarter) != (int(named[1]), int(named[2])):
                raise ValueError(f"{path} holds a member of another vintage: {name}")
            if wanted.kind(m.kind) and wanted.vintage(m.Year, m.Quarter):
                out.append(m)
    return out


def plan_members(paths, wanted: Wanted = Wanted()) -> list[Member]:
    with ThreadPoolExecutor(THREADS) as pool:
        return [m for found in pool.map(lambda p: members_of(p, wanted), paths) for m in found]


def read_member(part: Member, chunk_bytes: int = archives.CHUNK_BYTES):
    """Batches of lines of a member, streamed in chunks."""
    one = pa.RecordBatch.from_arrays([pa.array([part.path])], names=["path"])
    for batch in archives._lines([one], "^" + re.escape(part.member) + "$", chunk_bytes):
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("member"), pa.repeat(part.kind, n),
             pa.repeat(pa.scalar(part.Year, pa.int32()), n), pa.repeat(pa.scalar(part.Quarter, pa.int32()), n),
             batch.column("value")], schema=ARROW)


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: str, wanted: Wanted = Wanted()):
        self.folder, self.wanted = folder, wanted

    def partitions(self):
        return plan_members(list_archives(self.folder), self.wanted)

    def read(self, partition):
        if partition is not None:  # a folder without members has no partitions
            yield from read_member(partition)


class ArchiveStreamReader(DataSourceStreamReader):
    """Offsets are numbers of manifests; manifest n lists the archives that it adds."""

    def __init__(self, folder: str, manifest: str, wanted: Wanted = Wanted()):
        self.folder, self.manifest, self.wanted = folder, manifest.rstrip("/"), wanted

    def _manifests(self) -> list[int]:
        from pyarrow import fs
        filesystem, inner = archives._filesystem(self.manifest)
        found = filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        return sorted(int(i.base_name[:-5]) for i in found if re.fullmatch(r"\d+\.json", i.base_name))

    def _listed(self, n: int) -> list[str]:
        filesystem, inner = archives._filesystem(f"{self.manifest}/{n}.json")
        with filesystem.open_input_stream(inner) as f:
            return json.loads(f.read())

    def initialOffset(self):
        return {"manifest": 0}

    def latestOffset(self):
        numbers = self._manifests()
        with ThreadPoolExecutor(THREADS) as pool:
            seen = {p for listed in pool.map(self._listed, numbers) for p in listed}
        last, new = max(numbers, default=0), [p for p in list_archives(self.folder) if p not in seen]
        if not new:
            return {"manifest": last}
        filesystem, inner = archives._filesystem(self.manifest)
        filesystem.create_dir(inner, recursive=True)
        with filesystem.open_output_stream(f"{inner}/{last + 1}.part") as f:
            f.write(json.dumps(new).encode())
        filesystem.move(f"{inner}/{last + 1}.part", f"{inner}/{last + 1}.json")  # whole or not at all
        return {"manifest": last + 1}

    def partitions(self, start, end):
        paths = [p for n in range(start["manifest"] + 1, end["manifest"] + 1) for p in self._listed(n)]
        return plan_members(paths, self.wanted)

    def read(self, partition):
        return read_member(partition)

    def commit(self, end):
        pass


class LoanArchives(DataSource):
    """Options: ``path`` (a folder), ``kinds`` and ``quarters`` (comma-separated, such as 2015Q1;
    all by default), and for streams ``manifest`` (a folder of the query's own)."""

    @classmethod
    def name(cls):
        return "loan_archives"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ArchiveReader(self.options["path"], Wanted.of(self.options))

    def streamReader(self, schema):
        return ArchiveStreamReader(self.options["path"], self.options["manifest"], Wanted.of(self.options))


def _reader(reader, spark: SparkSession, kinds, quarters):
    ship_package(spark)
    spark.dataSource.register(LoanArchives)
    reader = reader.format("loan_archives")
    if kinds is not None:
        reader = reader.option("kinds", ",".join(kinds))
    if quarters is not None:
        reader = reader.option("quarters", ",".join(f"{y}Q{q}" for y, q in quarters))
    return reader


def archive_lines(spark: SparkSession, folder: str, kinds=None, quarters=None) -> DataFrame:
    """The lines of the loan members below ``folder``, of the given kinds and (year, quarter)
    pairs only (see the module's docstring)."""
    return _reader(spark.read, spark, kinds, quarters).load(archives.qualified(spark, folder))


def stream_archive_lines(spark: SparkSession, folder: str, manifest: str, kinds=None, quarters=None) -> DataFrame:
    """The same as a stream of the archives that arrive."""
    return (_reader(spark.readStream, spark, kinds, quarters)
            .option("manifest", archives.qualified(spark, manifest)).load(archives.qualified(spark, folder)))


def parsed(lines: DataFrame) -> DataFrame:
    """kind, Year, Quarter and the line's record in the column of its kind (the other null)."""
    def record(kind, schema):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return F.when(F.col("kind") == kind, F.from_csv("line", ddl, {"sep": "|", "mode": "FAILFAST"})).alias(kind)
    return lines.select("kind", "Year", "Quarter", record("origination", ORIGINATION_SCHEMA),
                        record("performance", PERFORMANCE_SCHEMA))


def landed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(origination, performance) of a landed table, each reading its own partitions only."""
    table = spark.read.parquet(path)
    return tuple(table.where(F.col("kind") == kind).select(f"{kind}.*", "Year", "Quarter")
                 for kind in ("origination", "performance"))


def land_archives(spark: SparkSession, folder: str, path: str | None = None,
                  quarters=None) -> tuple[DataFrame, DataFrame]:
    """Both loan tables from one pass over the archives: every member is read once and
    written to a Parquet table by kind and vintage, from which each table reads its part.
    ``quarters`` skips archives of other vintages."""
    path = path or scratch_path(spark, "landed")
    parsed(archive_lines(spark, folder, quarters=quarters)).write.mode("overwrite").partitionBy(
        "kind", "Year", "Quarter").parquet(path)
    return landed(spark, path)


def land_new_archives(spark: SparkSession, folder: str, path: str, checkpoint_path: str):
    """Appends the archives that the landed table lacks (``availableNow``; the Parquet sink's
    log makes every batch count once)."""
    lines = stream_archive_lines(spark, folder, checkpoint_path.rstrip("/") + "-manifest")
    q = (parsed(lines).writeStream.format("parquet").partitionBy("kind", "Year", "Quarter").option("path", path)
         .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
