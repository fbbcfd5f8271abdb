"""Embedding near-duplicates with one hierarchical navigable small-world graph per shard.

Equal vectors are joined to one representative first. Representatives are hashed to
shards; each shard's graph is built in one task (points enter in batches that search the
graph so far, choose diverse neighbours and link back) and written once. For every pair of
shards one task asks each graph about the other's points, chunk by chunk. A query's beam is
doubled while its worst member still reaches the threshold, and all beams of a chunk are
doubled until every query of an audit - an eighth of the chunk, spread over queries with few
and many links, against all vectors of the shard - has found the wanted recall of its links.
A pair that either point finds is a link of both. What the beams find is verified by the
cosine in double precision; per task only counts and a spanning forest of the links leave,
and components are joined in Spark.

Defined results: null, empty, zero vectors and such with null or non-finite components
link with nothing; vectors of different length never link; equal vectors link; repeated
rows are vectors of their own with one vec_id; an empty table gives no rows; extra
columns are ignored."""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pick
from .components import connected_components

LINKS, BUILD_BEAM = 16, 48


class Graph:
    """Vectors of unit length (float32), their level-wise neighbour lists (-1: none)."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    def search(self, q: np.ndarray, beam: int, layer: int, start: np.ndarray):
        """For each query the ``beam`` best points of a layer reached from ``start``
        (ids, similarities; -1 and -inf fill up). All queries step together."""
        n, width = len(q), beam
        nbrs, x = self.layers[layer], self.x
        ids = np.full((n, width), -1, np.int64)
        sims = np.full((n, width), -np.inf, np.float32)
        k = min(start.shape[1], width)
        ids[:, :k] = start[:, :k]
        sims[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("qkd,qd->qk", x[ids[:, :k]], q), -np.inf)
        open_ = ids >= 0
        seen = np.zeros((n, len(x)), bool)
        row, col = np.nonzero(open_)
        seen[row, ids[row, col]] = True
        active = np.arange(n)
        while len(active):
            best = np.where(open_[active], sims[active], -np.inf).argmax(1)
            live = open_[active, best]
            active, best = active[live], best[live]
            if not len(active):
                break
            open_[active, best] = False
            cand = nbrs[ids[active, best]]
            ok = (cand >= 0) & ~seen[active[:, None], np.maximum(cand, 0)]
            r, c = np.nonzero(ok)
            seen[active[r], cand[r, c]] = True
            new = np.full(cand.shape, -np.inf, np.float32)
            new[r, c] = np.einsum("ed,ed->e", x[cand[r, c]], q[active[r]])
            gain = (new > sims[active].min(1)[:, None]).any(1)
            rows = active[gain]
            if len(rows):
                all_s = np.concatenate([sims[rows], new[gain]], 1)
                all_i = np.concatenate([ids[rows], np.where(ok[gain], cand[gain], -1)], 1)
                all_o = np.concatenate([open_[rows], ok[gain]], 1)
                top = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
                sims[rows] = np.take_along_axis(all_s, top, 1)
                ids[rows] = np.take_along_axis(all_i, top, 1)
                open_[rows] = np.take_along_axis(all_o, top, 1) & (ids[rows] >= 0)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def query(self, q: np.ndarray, beam: int):
        at = np.full((len(q), 1), self.entry, np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            at = self.search(q, 1, layer, at)[0]
        return self.search(q, beam, 0, at)

    def dump(self) -> bytes:
        buf = io.BytesIO()
        np.savez(buf, x=self.x, entry=self.entry, **{f"l{i}": a for i, a in enumerate(self.layers)})
        return buf.getvalue()

    @staticmethod
    def load(raw: bytes) -> "Graph":
        z = np.load(io.BytesIO(raw))
        return Graph(z["x"], [z[f"l{i}"] for i in range(len(z.files) - 2)], int(z["entry"]))


def _diverse(x: np.ndarray, q: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """From candidates in falling order: those nearer to the query than to any chosen one;
    free places go to the nearest of the rest."""
    n, k = ids.shape
    v = x[np.maximum(ids, 0)]
    cross = np.einsum("nid,njd->nij", v, v)
    chosen = np.zeros((n, k), bool)
    for j in range(k):
        near = np.where(chosen, cross[:, j, :], -np.inf).max(1)
        chosen[:, j] = (ids[:, j] >= 0) & (near < sims[:, j]) & (chosen.sum(1) < keep)
    rank = np.where(chosen, 0, np.where(ids >= 0, 1, 2)) * k + np.arange(k)
    top = np.argsort(rank, axis=1)[:, :keep]
    out = np.take_along_axis(ids, top, 1)
    if out.shape[1] < keep:
        out = np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)
    return out


def build(x: np.ndarray, seed: int = 3, links: int = LINKS, beam: int = BUILD_BEAM) -> tuple[Graph, np.ndarray]:
    """The graph of unit vectors (at least one) and the order in which it holds them."""
    n = len(x)
    level = np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(links)).astype(int), 6)
    order = np.argsort(-level, kind="stable")
    x, level = np.ascontiguousarray(x[order], np.float32), level[order]  # top levels enter first
    layers = [np.full((n, 2 * links if i == 0 else links), -1, np.int64) for i in range(int(level[0]) + 1)]
    g = Graph(x, layers, 0)
    done = 1
    while done < n:
        size = min(n - done, done, 512)
        new = np.arange(done, done + size)
        q, at = x[new], np.zeros((size, 1), np.int64)
        inside = q @ q.T
        np.fill_diagonal(inside, -np.inf)
        for layer in range(len(layers) - 1, -1, -1):
            into = level[new] >= layer
            if not into.any():
                at = g.search(q, 1, layer, at)[0]
                continue
            found_i, found_s = g.search(q, beam, layer, at)
            at = found_i
            rows = np.flatnonzero(into)
            # points of the same batch are candidates of each other
            peers = np.where(into[None, :], inside[rows], -np.inf)
            k = min(16, size)
            top = np.argpartition(-peers, k - 1, axis=1)[:, :k]
            ps = np.take_along_axis(peers, top, 1)
            ids = np.concatenate([found_i[rows], np.where(np.isfinite(ps), new[top], -1)], 1)
            sims = np.concatenate([found_s[rows], ps], 1)
            o = np.argsort(-sims, axis=1, kind="stable")
            keep = layers[layer].shape[1]
            mine = _diverse(x, q[rows], np.take_along_axis(ids, o, 1), np.take_along_axis(sims, o, 1), min(links, keep))
            layers[layer][new[rows], : mine.shape[1]] = mine
            _link_back(x, layers[layer], new[rows], mine)
        done += size
    return g, order


def _link_back(x: np.ndarray, nbrs: np.ndarray, new: np.ndarray, mine: np.ndarray) -> None:
    r, c = np.nonzero(mine >= 0)
    src, dst = new[r], mine[r, c]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    keep, most = nbrs.shape[1], 64
    for a in range(0, len(nodes), 256):
        some, f, n = nodes[a:a + 256], first[a:a + 256], np.minimum(count[a:a + 256], most)
        width = int(n.max())
        add = np.full((len(some), width), -1, np.int64)
        for i in range(width):
            at = n > i
            add[at, i] = src[f[at] + i]
        ids = np.concatenate([nbrs[some], add], 1)
        ids.sort(axis=1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        full = (ids >= 0).sum(1) > keep
        flat = ids[~full]
        nbrs[some[~full]] = np.take_along_axis(flat, np.argsort(flat < 0, axis=1, kind="stable"), 1)[:, :keep]
        if full.any():
            ids, own = ids[full], some[full]
            sims = np.where(ids >= 0, np.einsum("nkd,nd->nk", x[np.maximum(ids, 0)], x[own]), -np.inf)
            o = np.argsort(-sims, axis=1, kind="stable")
            nbrs[own] = _diverse(x, x[own], np.take_along_axis(ids, o, 1), np.take_along_axis(sims, o, 1), keep)


def audited(count: np.ndarray, size: int) -> np.ndarray:
    """About ``size`` queries to audit: as many of each order of magnitude of links found, so
    that a large group leaves places to queries with few links or none."""
    level = np.log2(count + 1).astype(int)
    groups = [np.flatnonzero(level == i) for i in np.unique(level)]
    each = -(-size // len(groups))
    return np.concatenate([g[np.linspace(0, len(g) - 1, min(each, len(g))).astype(int)] for g in groups])


def linked(graph: Graph, q: np.ndarray, threshold: float, beam: int = 32, recall: float = 0.995, audit: int = 64,
           own: np.ndarray | None = None):
    """(query, point) of all pairs with similarity over the threshold that the graph finds;
    beams widen query by query while full, and together until every audited query has found
    ``recall`` of its links. At least ``audit`` queries and an eighth of all are audited;
    ``own`` gives the queries' own points, which the audit leaves out."""
    n, slack = len(graph.x), threshold - 1e-4  # float32; the caller verifies in double precision
    sample = None
    while True:
        rows, cols, todo, width = [], [], np.arange(len(q)), min(beam, n)
        while len(todo):
            again = []
            step = max(1, min(len(todo), (1 << 24) // (n + 64 * width)))
            for a in range(0, len(todo), step):
                part = todo[a:a + step]
                if width >= n:
                    r, c = np.nonzero(q[part] @ graph.x.T >= slack)
                else:
                    ids, sims = graph.query(q[part], width)
                    full = sims[:, -1] >= slack
                    again.append(part[full])
                    hit = (sims >= slack) & ~full[:, None]
                    r, k = np.nonzero(hit)
                    c = ids[r, k]
                rows.append(part[r])
                cols.append(c)
            todo = np.concatenate(again) if again else np.zeros(0, int)
            width = min(4 * width, n)
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        if beam >= n:
            return rows, cols
        if sample is None:
            others = rows if own is None else rows[cols != own[rows]]
            sample = audited(np.bincount(others, minlength=len(q)), max(audit, len(q) // 8))
            truth = graph.x @ q[sample].T >= slack
            if own is not None:
                truth[own[sample], np.arange(len(sample))] = False
        got = np.zeros_like(truth)
        place = np.full(len(q), -1)
        place[sample] = np.arange(len(sample))
        at = place[rows] >= 0
        got[cols[at], place[rows[at]]] = True
        if ((got & truth).sum(0) >= recall * truth.sum(0)).all():
            return rows, cols
        beam *= 2


def between(g: Graph, x: np.ndarray, h: Graph, y: np.ndarray, threshold: float, chunk_rows: int) -> np.ndarray:
    """Which points of ``g`` (vectors ``x`` in double precision) and ``h`` (``y``) are linked, as
    a matrix: a pair that either point finds counts. With ``g`` as ``h``, each pair once."""
    hit = np.zeros((len(x), len(y)), bool)
    same = g is h
    for graph, q, p, out in ((h, x, y, hit),) if same else ((h, x, y, hit), (g, y, x, hit.T)):
        for a in range(0, len(q), chunk_rows):
            part = q[a:a + chunk_rows]
            r, c = linked(graph, part.astype(np.float32), threshold, own=np.arange(a, a + len(part)) if same else None)
            for e in range(0, len(r), 65536):
                i, j = r[e:e + 65536], c[e:e + 65536]
                ok = np.einsum("ed,ed->e", part[i], p[j]) >= threshold
                out[a + i[ok], j[ok]] = True
    if same:
        for a in range(len(x)):  # the pair (i, j), i < j, from either direction
            hit[a, a + 1:] |= hit[a + 1:, a]
            hit[a, :a + 1] = False
    return hit


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    parent: dict[int, int] = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(i), root(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.9, shards: int = 8,
                    shard_rows: int = 16_384, chunk_rows: int = 4096, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    v = pick(vectors, vec_id=id_col, v=vector_col).withColumn("v", F.col("v").cast("array<double>"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    good = F.coalesce((F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & (norm > 0) & (norm < float("inf")), F.lit(False))
    v = materialize(spark, v.withColumn("good", good), "hnsw-input")
    reps = v.where("good").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    reps = materialize(spark, reps.where("rep is not null").withColumn("dim", F.size("v")), "hnsw-distinct")
    total = reps.count()
    shards = max(shards, -(-total // shard_rows))
    reps = reps.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))

    def matrix(table: pa.Table) -> np.ndarray:
        col = table.column("v").combine_chunks()
        return col.values.to_numpy().reshape(len(col), -1)

    def unit(x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def index(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        x, rep, m = unit(matrix(table)), table.column("rep").to_numpy(), table.column("m").to_numpy()
        g, order = build(x)
        buf = io.BytesIO()
        np.savez(buf, rep=rep[order], m=m[order], x=x[order])
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                         pa.array([g.dump()]), pa.array([buf.getvalue()])], names=["dim", "shard", "graph", "points"])

    graphs = reps.select("dim", "shard", "rep", "m", "v").groupBy("dim", "shard").applyInArrow(
        index, "dim int, shard int, graph binary, points binary")
    graphs = materialize(spark, graphs, "hnsw-graphs")

    answer = pa.schema([("rep", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def ask(key: tuple, some: pa.Table) -> pa.Table:
        some = some.sort_by("shard")
        if some.num_rows == 1 and key[1] != key[2]:
            return answer.empty_table()
        sides = []
        for graph, points in zip(some.column("graph"), some.column("points")):
            z = np.load(io.BytesIO(points.as_py()))
            sides.append((Graph.load(graph.as_py()), z["rep"], z["m"], z["x"]))
        (g, rep, m, x), (h, ids, w, y) = sides[0], sides[-1]
        hit = between(g, x, h, y, threshold, chunk_rows)
        left, right, edges = np.zeros(len(x)), np.zeros(len(y)), []
        for a in range(0, len(x), chunk_rows):
            r, c = np.nonzero(hit[a:a + chunk_rows])
            r += a
            left += np.bincount(r, weights=w[c], minlength=len(x))
            right += np.bincount(c, weights=m[r], minlength=len(y))
            edges += forest(rep[r], ids[c])
        n, who = np.concatenate([left, right]).astype("i8"), np.concatenate([rep, ids])
        has = np.flatnonzero(n)
        return pa.table([pa.array(np.concatenate([who[has], np.array([a for a, _ in edges], "i8")])),
                         pa.array([None] * len(has) + [b for _, b in edges], pa.int64()),
                         pa.array(np.concatenate([n[has], np.zeros(len(edges), "i8")]))], schema=answer)

    # both directions of a pair of shards are asked in one task, so that links are symmetric
    other = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    pairs = other.select("dim", F.least("shard", "other").alias("a"), F.greatest("shard", "other").alias("b"),
                         "shard", "graph", "points")
    found = pairs.groupBy("dim", "a", "b").applyInArrow(ask, "rep long, other long, n long")
    found = materialize(spark, found, "hnsw-found")
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    comp = connected_components(spark, found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    per = (reps.select("v", "rep", "m").join(links, "rep", "left")
           .join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
           .select("v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                   F.coalesce("component", "rep").alias("component_id")))
    out = v.where("good").join(per, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                        F.coalesce("component_id", "vec_id").alias("component_id"))
    out = out.union(v.where("not good").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
