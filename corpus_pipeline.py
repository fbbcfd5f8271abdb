"""From raw documents to packed training sequences: five stages, each applying one operator
to all that its predecessor kept. Every stage takes (spark, docs, sf_dir); its result is
written as Parquet to the shared folder and read again as the next stage's ``docs``, so a
lost executor never costs more than one stage's tasks.

Defined results of the stages: null texts count as empty, and empty and null texts are clean,
hold no secret and have no near duplicate; a null id is an id like another (rows of one id stay
or go together as near duplicates); null sources are a source; repeated rows are kept or taken
each; texts are read whole at any length; empty tables give empty tables; further columns pass
through unchanged, whatever their names."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import best_fit, cube_mixing, jaccard_tiles, secret_scan, toxicity_kn
from panelforge.llm.common import materialize, table
from panelforge.llm.queries import vocabulary
from panelforge.session import checkpoint_dir


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def any_names(stage):
    """The stage sees the columns of documents by these names and all others by number, so that
    names that clash with them (or among themselves) do no harm; they come back as they were."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        known = {names.index(c) for c in COLUMNS if c in names}
        plain = docs.toDF(*[c if i in known else f"further__{i}" for i, c in enumerate(names)])
        return stage(spark, plain, sf_dir).toDF(*names)
    return run


@any_names
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the class-conditional models call toxic (score 0.7 or more)."""
    checkpoint_dir(spark)
    fitted = toxicity_kn.fit(spark, docs, table(spark, sf_dir, "labels"),
                             learn_from=~toxicity_kn.held_out(F.col("doc_id")))
    return toxicity_kn.score(spark, docs, fitted, "toxicity__score").where("toxicity__score < 0.7").select(*docs.columns)


@any_names
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of 5-word-shingle Jaccard >= 0.8.
    Rows with one doc_id are one document and stay or go together."""
    checkpoint_dir(spark)
    classes = jaccard_tiles.jaccard_classes(spark, docs, shingle=5, threshold=(8, 10))
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("gone__id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone__id"), "left_anti")


@any_names
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks live-looking secrets in the texts; clean documents and copied examples stay."""
    checkpoint_dir(spark)
    return secret_scan.mask(spark, docs)


@any_names
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that each source nears its target share of words."""
    checkpoint_dir(spark)
    mixed = cube_mixing.mix(spark, docs).where("mix_copies > 0")
    return mixed.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token pieces of the mix into sequences of 2048."""
    checkpoint_dir(spark)
    return best_fit.pack(spark, docs, vocabulary())[1]


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing),
          ("packing", packing)]

#: Model scores, the draw of the mix and token ids are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
