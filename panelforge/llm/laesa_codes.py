"""Vector codes: integer product quantisation whose assignments run over LAESA pivots.

Components become integers floor(scale * x) and vectors are cut into equal consecutive parts;
every part position has a codebook of a few entries, seeded by the smallest ids and moved for
some rounds to the floored mean of its parts. All arithmetic is in integers, so results don't
depend on how rows are dealt to tasks.

LAESA: each position has a few fixed pivots (seed entries far from each other). The floored
distances of every part to its pivots are computed once and written beside the vector. A round
computes only the pivot-entry distances; for a part x, an entry e and a pivot p the triangle
inequality gives d(x, e) > |floor d(x, p) - floor d(p, e)| - 1. Entries are tried in the order
of the greatest such bound, and a part is done when the next bound squared exceeds its best
squared distance: ties are still evaluated, so the winner is that of the full search.

A round is one pass over the written table: tasks send sums per (position, entry, component),
whose number depends on the parameters alone, and the codebooks on the driver have that size too.

Defined results: vectors that are null or hold null or non-finite components are dropped; the
dimension is that of the smallest vec_id whose length the parts divide, and vectors of other
lengths come back with null code and error; a null vec_id is coded but seeds nothing; a vec_id
that comes with several vectors seeds one entry, its smallest vector; repeated rows are coded
and counted each; with fewer ids than entries the codebooks are smaller; an empty table gives
no rows; extra columns are ignored. Components so large that squared distances might leave 64
bits (for 64 of them, beyond about 46,000) raise a ValueError."""

from __future__ import annotations

import hashlib
import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, pick


def root(squares: np.ndarray) -> np.ndarray:
    """Floors of the square roots of non-negative int64, exact."""
    r = np.minimum(np.sqrt(squares.astype(np.float64)).astype(np.int64), math.isqrt((1 << 63) - 1))
    r -= r * r > squares
    return r + (squares - r * r > 2 * r)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (rows of x, entries)."""
    return ((x[:, None, :] - entries[None, :, :]) ** 2).sum(2)


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the entries, each the farthest from those before; the first is entry 0."""
    picked = [0]
    near = distances(entries, entries[:1])[:, 0]
    while len(picked) < n and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, distances(entries, entries[picked[-1:]])[:, 0])
    return entries[picked]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray):
    """(entry, squared distance, exact evaluations) of the rows of ``x``: the nearest of
    ``entries``, ties to the lower index. ``to_pivots``: floored distances to ``pivots``."""
    of_entries = root(distances(entries, pivots))
    bound = np.zeros((len(x), len(entries)), np.int64)
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_entries[None, :, p]) - 1, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound *= bound
    best = np.full(len(x), np.iinfo(np.int64).max)
    at, tried, alive = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), np.arange(len(x))
    for r in range(len(entries)):
        e = order[alive, r]
        go = bound[alive, e] <= best[alive]
        alive, e = alive[go], e[go]
        if not len(alive):
            break
        d = ((x[alive] - entries[e]) ** 2).sum(1)
        tried[alive] += 1
        win = (d < best[alive]) | ((d == best[alive]) & (e < at[alive]))
        best[alive[win]], at[alive[win]] = d[win], e[win]
    return at, best, tried


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _smallest_ids(spark: SparkSession, rows: DataFrame, n: int) -> list[int]:
    """The ``n`` smallest distinct vec_ids, at most ``n`` sent by each task."""
    def run(batches):
        least = []
        for batch in batches:
            least = heapq.nsmallest(n, set(least).union(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(least, pa.int64())], names=["vec_id"])

    ids = rows.where("vec_id is not null").select("vec_id").mapInArrow(run, "vec_id long")
    return [r.vec_id for r in ids.distinct().orderBy("vec_id").limit(n).collect()]


def compress(spark: SparkSession, vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
             pivots: int = 4, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(coded, codebooks). ``coded``: vec_id, label, codes (list of entry indexes), error (sum of
    the squared distances), evaluated (exact distances computed for the last assignment).
    ``codebooks``: one integer matrix per part position."""
    d = pick(vectors, vec_id=id_col, embedding=vector_col, label=label_col)
    good = d.where(F.col("embedding").isNotNull()).withColumn("embedding", F.col("embedding").cast("array<double>")).where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    label_type = d.schema["label"].dataType
    size = F.size("embedding")
    first = good.where(F.col("vec_id").isNotNull() & (size > 0) & (size % parts == 0)).select(
        "vec_id", size.alias("size")).orderBy("vec_id", "size").first()
    if first is None:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("codes", "array<int>"), ("error", "long"), ("evaluated", "long"))]
        return good.select("vec_id", "label", *none), []
    dim = first["size"]
    width, limit = dim // parts, math.isqrt(((1 << 63) - 1) // dim) // 2
    whole = good.where(size == dim)
    greatest = whole.agg(F.max(F.greatest(F.array_max("embedding"), -F.array_min("embedding")))).first()[0]
    if greatest * scale >= limit:
        raise ValueError(f"components up to {greatest} times {scale}: squared distances may leave 64 bits")

    def integers(column) -> np.ndarray:
        return np.floor(_matrix(column, dim) * scale).astype(np.int64)

    seeds = _smallest_ids(spark, whole, entries)
    picked = whole.where(F.col("vec_id").isin(seeds)).groupBy("vec_id").agg(F.min("embedding").alias("e")).orderBy("vec_id")
    table = np.floor(np.array([r.e for r in picked.collect()], np.float64) * scale).astype(np.int64)
    books = [table[:, p * width:(p + 1) * width] for p in range(parts)]
    fixed = [choose_pivots(b, pivots) for b in books]

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label_type),
                           T.StructField("x", T.ArrayType(T.IntegerType())),
                           T.StructField("to_pivots", T.ArrayType(T.IntegerType()))])

    def measure(batches):
        for batch in batches:
            x = integers(batch.column(2))
            near = np.concatenate([root(distances(x[:, p * width:(p + 1) * width], fixed[p])) for p in range(parts)], axis=1)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()),
                                              pa.array(m.ravel().astype(np.int32))) for m in (x, near)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=schema.names)

    measured = materialize(spark, whole.select("vec_id", "label", "embedding").mapInArrow(measure, schema), "laesa-parts")
    spans = np.cumsum([0] + [len(f) for f in fixed])

    def assign(x, near, books):
        for p in range(parts):
            xp = x[:, p * width:(p + 1) * width]
            yield p, xp, *nearest(xp, near[:, spans[p]:spans[p + 1]], books[p], fixed[p])

    for _ in range(rounds):
        def sums(batches, books=tuple(books)):
            n, s = np.zeros((parts, len(seeds)), np.int64), np.zeros((parts, len(seeds), width), np.int64)
            for batch in batches:
                x, near = (_matrix(batch.column(i), w).astype(np.int64) for i, w in ((0, dim), (1, spans[-1])))
                for p, xp, at, _, _ in assign(x, near, books):
                    n[p] += np.bincount(at, minlength=len(seeds))
                    np.add.at(s[p], at, xp)
            p, e, c = np.indices(s.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.ravel()) for a in (p, e, c, np.broadcast_to(n[:, :, None], s.shape), s)], names=list("pecns"))

        got = measured.select("x", "to_pivots").mapInArrow(sums, "p long, e long, c long, n long, s long").groupBy(
            "p", "e", "c").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > 0").collect()
        books = [b.copy() for b in books]
        for r in got:
            books[r.p][r.e, r.c] = r.s // r.n

    out = T.StructType([schema["vec_id"], schema["label"], T.StructField("codes", T.ArrayType(T.IntegerType())),
                        T.StructField("error", T.LongType()), T.StructField("evaluated", T.LongType())])

    def code(batches):
        for batch in batches:
            x, near = (_matrix(batch.column(i), w).astype(np.int64) for i, w in ((2, dim), (3, spans[-1])))
            codes, error, tried = np.zeros((len(x), parts), np.int32), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            for p, _, at, best, n in assign(x, near, books):
                codes[:, p] = at
                error += best
                tried += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * parts, pa.int32()), pa.array(codes.ravel())),
                 pa.array(error), pa.array(tried)], names=out.names)

    coded = measured.mapInArrow(code, out)
    other = good.where(size != dim).select("vec_id", "label", *[F.lit(None).cast(f.dataType).alias(f.name) for f in out.fields[2:]])
    return materialize(spark, coded.union(other), "laesa-codes"), books


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
