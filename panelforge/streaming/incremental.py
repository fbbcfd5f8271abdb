"""Incremental processing of newly arrived loan archives with Structured Streaming.

The vintage is the unit of work. The file source tracks which archives were already seen;
every micro-batch names the vintages that its archives touch and marks them as due. A vintage
is processed by the batch that brings the last of its archives present in the run (by the end of
the run at the latest), from all of its archives, which are read once and not once a batch. So the
parts of a vintage may arrive in any order, in any number of batches and late: its partition is
always rewritten whole (dynamic partition overwrite; a retried batch rewrites the same). Marks
lie beside the checkpoint until the vintage is written, so an interrupted run loses none: the
next run takes them up. A vintage of which only one member kind has arrived has no panel rows
until the other one comes.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_origination, clean_performance
from ..plans.pipeline import run_process
from ..sources.archives import _filesystem, ingest_loan_archives, qualified
from ..sources.quarters import missing_quarters


def with_vintage(paths: DataFrame) -> DataFrame:
    """Adds (Year, Quarter) from the archive's file name (``...2015Q3....zip``)."""
    rx = r"(\d{4})Q(\d)[^/]*$"
    return paths.withColumns({"Year": F.regexp_extract("path", rx, 1).cast("int"),
                              "Quarter": F.regexp_extract("path", rx, 2).cast("int")})


def archives_present(spark: SparkSession, archive_dir: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(archive_dir)
    return with_vintage(files.select("path", "length"))


def _process_vintages(spark: SparkSession, archive_dir: str, vintages: DataFrame, processed_path: str) -> None:
    files = archives_present(spark, archive_dir).join(F.broadcast(vintages), ["Year", "Quarter"], "left_semi")
    orig, perf = ingest_loan_archives(spark, files.select("path", "length"))
    run_process(spark, clean_origination(orig), clean_performance(perf), processed_path)


class DueVintages:
    """Vintages touched by a batch and not yet written: one empty file each in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.filesystem, self.folder = _filesystem(qualified(spark, folder))
        self.filesystem.create_dir(self.folder, recursive=True)

    def all(self) -> list:
        from pyarrow import fs
        names = [f.base_name for f in self.filesystem.get_file_info(fs.FileSelector(self.folder))]
        return sorted(tuple(map(int, n.split("Q"))) for n in names if re.fullmatch(r"\d{4}Q\d", n))

    def add(self, vintages) -> None:
        for y, q in vintages:
            self.filesystem.open_output_stream(f"{self.folder}/{y:04d}Q{q}").close()

    def remove(self, vintages) -> None:
        for y, q in vintages:
            self.filesystem.delete_file(f"{self.folder}/{y:04d}Q{q}")


def process_new_archives(spark: SparkSession, archive_dir: str, processed_path: str,
                         checkpoint_path: str, max_files_per_trigger: int | None = None):
    """Run until every archive now present is processed (``availableNow`` trigger)."""
    due = DueVintages(spark, checkpoint_path.rstrip("/") + "-due")
    awaited: dict = {}  # vintage -> its archives that no batch of this run has brought yet

    def process(vintages: list) -> None:
        if vintages:
            _process_vintages(spark, archive_dir, spark.createDataFrame(vintages, "Year int, Quarter int"), processed_path)
            due.remove(vintages)

    def batch(df: DataFrame, epoch: int) -> None:
        new = with_vintage(df.select("path")).collect()  # names of files, which the source's log holds too
        touched = sorted({(r.Year, r.Quarter) for r in new})
        if not touched:
            return
        due.add(touched)
        if not awaited:
            for r in archives_present(spark, archive_dir).select("path", "Year", "Quarter").collect():
                awaited.setdefault((r.Year, r.Quarter), set()).add(r.path)
        for r in new:
            awaited.get((r.Year, r.Quarter), set()).discard(r.path)
        process([v for v in touched if not awaited.get(v)])

    reader = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.zip"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(archive_dir).select("path").writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    q.awaitTermination()
    process(due.all())
    return q


def process_archives(spark: SparkSession, archive_dir: str, processed_path: str, quarters: list,
                     refresh: bool = False) -> list:
    """Process the wanted vintages that the processed table lacks, or all of them with
    ``refresh``. Refuses to run when a vintage to process has no archive. Returns the
    vintages it processed."""
    wanted = spark.createDataFrame([tuple(q) for q in quarters], "Year int, Quarter int")
    todo = wanted
    if not refresh:
        try:
            todo = missing_quarters(wanted, spark.read.parquet(processed_path))
        except AnalysisException:  # nothing processed so far
            todo = wanted
    work = sorted(tuple(r) for r in todo.collect())
    if not work:
        return work
    todo = spark.createDataFrame(work, "Year int, Quarter int")
    absent = sorted(tuple(r) for r in missing_quarters(todo, archives_present(spark, archive_dir)).collect())
    if absent:
        raise RuntimeError(f"no archives for vintages {absent}: fetch them first")
    _process_vintages(spark, archive_dir, todo, processed_path)
    return work


def vintages_present(spark: SparkSession, processed_path: str) -> DataFrame:
    return spark.read.parquet(processed_path).select("Year", "Quarter").distinct().orderBy("Year", "Quarter")
