"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path

#: ASCII white space: what separates words in every operator here.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, text="body")`` selects ``body`` as ``text``. Names are matched exactly
    (then without case) by position, so further columns whose names clash do no harm."""
    at = {}
    for out, name in columns.items():
        found = [i for i, c in enumerate(df.columns) if c == name] or \
                [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not found:
            raise ValueError(f"no column {name!r} in {df.columns}")
        at[out] = found[0]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(out) for out, i in at.items()])


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts the lineage,
    and a lost executor costs a re-read, not a recomputation."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: Column) -> Column:
    """Bytes of a text; null counts as empty."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def number_within(df: DataFrame, group: str, order: list[str], out: str, buckets: int = 64) -> DataFrame:
    """Adds ``out``: 0, 1, 2 ... without gaps inside each ``group``, in no task more than
    about 1/``buckets`` of a group. Rows are numbered inside (group, hash bucket) and
    shifted by the sizes of the earlier buckets. ``order`` must fix the rows' order up to
    identical rows; ``df`` is read twice, so it should be a written table."""
    b = f"{out}__bucket"
    df = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = df.groupBy(group, b).agg(F.count(F.lit(1)).alias(f"{out}__n"))
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, b, F.coalesce(F.sum(f"{out}__n").over(before), F.lit(0)).alias(f"{out}__first"))
    row = F.row_number().over(Window.partitionBy(group, b).orderBy(*order))
    return (df.withColumn(f"{out}__row", row).join(sizes, [group, b])
            .withColumn(out, (F.col(f"{out}__first") + F.col(f"{out}__row") - 1).cast("long"))
            .drop(b, f"{out}__row", f"{out}__first"))


def bitmap_of(df: DataFrame, column: str, bits: int = 27):
    """A numpy bitmap of ``1 << bits`` cells with those of the low bits of the long ``column``
    set: what a task may look up to skip rows early. Its size is bounded whatever ``df``
    holds; a false hit only lets a row through to the exact step behind it. A bitmap of few set
    cells is folded (to 256 a set cell or more), as every executor keeps a copy on its disk."""
    import numpy as np
    cell = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = df.select(F.shiftright(cell, 6).alias("word"), cell.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy(
        "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    held = int(np.bitwise_count(out).sum())
    while len(out) > 1 << 10 and 512 * held <= 64 * len(out):
        half = len(out) // 2
        out = out[:half] | out[half:]
    return out


def in_bitmap(bitmap, values):
    """Which of the uint64 ``values`` hit a set cell."""
    import numpy as np
    cell = values & np.uint64((len(bitmap) << 6) - 1)
    return (bitmap[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def raw_texts(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def slices(batches, column: int, limit: int = 1 << 20, rows: int = 256):
    """(part of a batch, bytes of its texts in ``column``) over Arrow batches, in parts of at
    most ``rows`` rows and about ``limit`` bytes: what a task holds as Python objects doesn't
    depend on how many or how long the texts of a batch are."""
    import pyarrow as pa
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            part = batch.slice(a, rows)
            raws, first, size = raw_texts(part.column(column)), 0, 0
            for i, t in enumerate(raws):
                size += len(t)
                if size >= limit or i + 1 == len(raws):
                    yield part.slice(first, i + 1 - first), raws[first:i + 1]
                    first, size = i + 1, 0
        pa.default_memory_pool().release_unused()
