"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source is taken floor(r) times, r = target words / source words, and
once more with probability r - floor(r). Which ones is decided by the cube method: inside
chunks of a source, three fractional documents at a time move along the null vector of
the two balancing equations (documents and words), in a random direction with the
probabilities that keep expectations, until one of them reaches 0 or 1. At most two stay
fractional per chunk (LANDING in a source's first); these meet in ever fewer chunks, and
the last LANDING of a source land on the 0/1 choice nearest to their expected words. Chunks are hash buckets, so a source with a third of
all rows is many tasks, and a chunk is decided by its rows and the seed alone: reruns and
retries agree.

Defined results: null text has 0 words; a null source is a source of its own, last in
order; sources without words have target 0 and none of their documents are taken; repeated
rows are drawn each; an empty table gives no rows; payload columns may have any names."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import WORD_PATTERN, materialize, pick

CHUNK = 1024
FAN_IN = 256
#: Documents that each source's first chunk leaves open for the landing.
LANDING = 14
EPS = 1e-9


def word_count(text) -> "F.Column":
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0) -> dict:
    """Source -> target words. Sources in code point order (null last) take the weights in
    turn and share ``share`` of all words; a target stops at ``ceiling`` times its source's
    words and the excess goes to the others by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if w[s] * level > ceiling * sizes[s]}
        if not full:
            return out | {s: w[s] * level for s in free}
        out |= {s: ceiling * sizes[s] for s in full}
        left, free = left - sum(out[s] for s in full), free - full
    return out


def _generator(*parts) -> np.random.Generator:
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return np.random.default_rng(int.from_bytes(digest, "little"))


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator, keep: int = 2) -> np.ndarray:
    """Moves ``prob`` until at most ``keep`` entries (or what two equations leave: two) are
    fractional, keeping sum(prob) and sum(prob * size)."""
    p, s = prob.astype("f8").tolist(), size.astype("f8").tolist()
    draws, at = rng.random(2 * len(p) + 8).tolist(), 0
    queue = [i for i in rng.permutation(len(p)).tolist() if EPS < p[i] < 1 - EPS]
    held: list[int] = []
    while True:
        held = [i for i in held if 0 < p[i] < 1]
        if len(held) + len(queue) <= keep:
            break
        while len(held) < 3 and queue:
            held.append(queue.pop())
        if len(held) == 3:
            a, b, c = held
            u = [s[c] - s[b], s[a] - s[c], s[b] - s[a]]
            scale = max(map(abs, u))
            u = [v / scale for v in u] if scale else [1.0, -1.0, 0.0]
        elif len(held) == 2 and s[held[0]] == s[held[1]]:
            u = [1.0, -1.0]
        else:
            break
        up = min(((1 - p[i]) / v if v > 0 else p[i] / -v) for i, v in zip(held, u) if v)
        down = min((p[i] / v if v > 0 else (1 - p[i]) / -v) for i, v in zip(held, u) if v)
        step, at = (up if draws[at % len(draws)] * (up + down) < down else -down), at + 1
        for i, v in zip(held, u):
            x = p[i] + step * v
            p[i] = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
    return np.array([0.0 if x < EPS else 1.0 if x > 1 - EPS else x for x in p])


def land(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The landing of the last few (at most LANDING) fractional documents of a source: of all
    0/1 choices the one nearest to their expected words, then to their expected number."""
    open_ = np.flatnonzero((prob > 0) & (prob < 1))
    if not len(open_):
        return prob
    s, p = size[open_].astype("f8"), prob[open_]
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = np.abs(choices @ s - p @ s)
    best = np.lexsort((np.abs(choices.sum(1) - p.sum()), np.round(off, 6)))[0]
    out = prob.copy()
    out[open_] = choices[best]
    return out


def _chunk_flight(prob, size, tie, seed, source, chunk):
    """Order of a chunk's rows (by size and hash) and their probabilities after the flight."""
    order = np.lexsort((tie, size))
    return order, flight(prob[order], size[order], _generator(seed, 0, int(source), int(chunk)),
                         LANDING if chunk == 0 else 2)


def _meeting(seed: int, depth: int, last: bool):
    """What the documents left open by up to FAN_IN chunks do together."""
    def again(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "chunk", "pos"])
        size = pdf["size"].to_numpy()
        p = flight(pdf["p"].to_numpy(), size, _generator(seed, depth, *map(int, key)), LANDING if key[1] == 0 else 2)
        if last:
            p = land(p, size)
        return pdf.assign(p=p, level=pdf["level"] // FAN_IN)
    return again


def mix(spark: SparkSession, docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5,
        ceiling: float = 2.0, seed: int = 11, chunk_rows: int = CHUNK, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", payload: list[str] | None = None) -> DataFrame:
    """``payload`` columns (all by default) of every row, then mix_size, mix_source_size,
    mix_target and mix_copies (how often the mix takes the row). The driver holds one row per source
    (metadata); documents move once, to their chunk."""
    names = list(docs.columns) if payload is None else payload
    plain = docs.toDF(*[f"p{i}" for i in range(len(docs.columns))])
    at = {c: f"p{docs.columns.index(c)}" for c in {id_col, text_col, source_col, *names}}
    keyed = plain.select(*[F.col(at[c]) for c in names],
                         F.col(at[source_col]).cast("string").alias("src"),
                         word_count(F.col(at[text_col])).alias("size"),
                         F.xxhash64(F.col(at[id_col]), F.col(at[text_col])).alias("tie"))
    stats = keyed.groupBy("src").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    goal = targets({r["src"]: r["w"] for r in stats}, weights, share, ceiling)
    rows = [(r["src"], i, r["w"], float(goal[r["src"]]), max(1, math.ceil(r["n"] / chunk_rows)),
             min(ceiling, goal[r["src"]] / r["w"]) if r["w"] else 0.0) for i, r in enumerate(stats)]
    sources = spark.createDataFrame(rows, "src2 string, sid int, source_size long, target double, chunks int, rate double")
    keyed = (keyed.join(sources, F.col("src").eqNullSafe(F.col("src2")))
             .withColumn("chunk", F.pmod(F.col("tie"), F.col("chunks")).cast("int")).drop("src", "src2", "chunks"))

    def leftovers(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf["rate"].iloc[0]
        order, p = _chunk_flight(np.full(len(pdf), r - math.floor(r)), pdf["size"].to_numpy(), pdf["tie"].to_numpy(),
                                 seed, *key)
        pos = np.flatnonzero((p > 0) & (p < 1))
        return pd.DataFrame({"sid": key[0], "chunk": key[1], "pos": pos, "size": pdf["size"].to_numpy()[order][pos],
                             "p": p[pos], "level": key[1]})

    state = "sid int, chunk int, pos int, size long, p double, level int"
    open_ = materialize(spark, keyed.select("sid", "chunk", "size", "tie", "rate").groupBy("sid", "chunk")
                        .applyInPandas(leftovers, state), "mix-open")
    decided, widest, depth = None, max([r[4] for r in rows], default=1), 0
    while True:
        last, depth = widest <= FAN_IN, depth + 1
        step = materialize(spark, open_.groupBy("sid", F.expr(f"level div {FAN_IN}").cast("int").alias("g"))
                           .applyInPandas(_meeting(seed, depth, last), state), "mix-level")
        settled = step.where("p = 0 or p = 1")
        decided = settled if decided is None else decided.union(settled)
        if last:
            break
        open_, widest = step.where("p > 0 and p < 1"), -(-widest // FAN_IN)

    fields = [docs.schema[docs.columns.index(c)] for c in names]
    out = StructType([StructField(f"o{i}", f.dataType, True) for i, f in enumerate(fields)] +
                     [StructField("mix_size", LongType()), StructField("mix_source_size", LongType()),
                      StructField("mix_target", DoubleType()), StructField("mix_copies", IntegerType())])
    arrow = to_arrow_schema(out)
    width = len(names)

    def final(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return arrow.empty_table()
        col = {c: left.column(c).to_numpy() for c in ("size", "tie", "rate")}
        r = col["rate"][0]
        order, p = _chunk_flight(np.full(len(left), r - math.floor(r)), col["size"], col["tie"], seed,
                                 *[k.as_py() for k in key])
        p[right.column("pos").to_numpy()] = right.column("p").to_numpy()
        copies = np.empty(len(left), "i4")
        copies[order] = math.floor(r) + np.rint(p).astype("i4")
        cols = [left.column(i) for i in range(width)] + [left.column(c) for c in ("size", "source_size", "target")]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)] + [pa.array(copies)], schema=arrow)

    taken = (keyed.groupBy("sid", "chunk").cogroup(decided.groupBy("sid", "chunk")).applyInArrow(final, out))
    return taken.toDF(*names, "mix_size", "mix_source_size", "mix_target", "mix_copies")
