"""N-gram Jaccard join in size-banded tiles with hashed bitmap signatures.

A document's set holds the hashes of its distinct shingles (3 words by default). Sets of
one content are joined once. Two sets of sizes a <= b with Jaccard >= p/q (9/10 by default)
differ in at most a * (q - p) / p elements; sizes are therefore cut into bands, a band fixes
a number of parts greater than that, elements fall into parts by hash, and by the pigeonhole
principle linked sets agree on one whole part. A tile is (band, part, hash of the part's
elements): every link lies in a tile, and unrelated documents hardly ever share one. A set
with more occupied parts than elements can differ shares an occupied one, so its empty parts
make no tile; the lower the threshold, the more parts a band has beyond the least number.

Inside the tiles the links that components need are found in rounds:

1. every member is compared with one leader, the smallest member of the tiles it shares
   most often, and the links give first components;
2. in tiles whose members are in different components, every member is compared with the few
   nearest of other components in its block and the next one, and with a few drawn by a hash
   (over all its tiles, not in each), and the links join components (``ROUNDS`` times, or until
   there is none);
3. tiles whose members are still in different components compare all members of different ones.

All pairs left out lie within one component, so no component is missed and no pairs of a
large group of copies are expanded; a group of near copies meets as one component in round 3. Before the exact intersection of the sorted arrays
every pair passes the bound: sizes a, b with bitmaps (of parities) that differ in x bits share at most
(a + b - x) / 2 elements. In rounds 2 and 3 the bound is computed on blocks of at most ``BLOCK`` members
of a tile against each other, as whole matrices, and only pairs that pass it become rows.
Near copies share many tiles; a member brings its ``LOWEST`` smallest ones along, and a pair
that shares a smaller tile than the present one is left to that one, so hardly any pair comes twice.
The tiles carry bitmaps of 512 bits, too few for differences of more than some hundred elements. Pairs that
pass them meet the bound again on bitmaps as wide as the sets, of 2 to 4 bits an element (the wider
one folded to the other's width): in the tile where both members carry theirs (folded to ``CARRIED``
bytes, in their smallest tiles), then as distinct rows. Only texts of pairs that pass those too are read.

Tiles are made for one row of each distinct set. Their hashes, cut to 40 bits, are counted first;
a bitmap of those met twice then drops all other tiles before any (tile, set) row is shuffled.

Defined results: null and empty texts have the empty set and link with nothing; texts of
one or two words are one shingle; documents with equal doc_id count as linked with each
other's links; repeated rows are returned each; an empty table gives no rows; extra
columns are ignored."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bitmap_of, in_bitmap, materialize, pick, raw_texts, slices
from .components import connected_components

THRESHOLD = (9, 10)  # op10's contract, as a fraction
WORDS = 8  # 64-bit words of a bitmap
BLOCK = 512  # members of a tile that a task compares at a time
ROUNDS, NEAREST, DRAWN = 2, 4, 2  # of round 2, and members that a member is compared with there
LOWEST = 8  # tiles of a member by which a pair is left to one of the tiles it shares
CARRIED = 512  # bytes of a wide bitmap that goes into a member's smallest tiles
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text; word hashes in a bounded cache."""

    def __init__(self, n: int = 3, limit: int = 150_000):
        self.n, self.limit, self.known = n, limit, {}

    def __call__(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()  # A-Z only; ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > self.limit:
            self.known = {}
        known, out = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        ids = np.array(out, dtype=np.uint64)
        width = min(self.n, len(ids))
        acc = np.full(len(ids) - width + 1, 0x9E37 + width, np.uint64)
        for i in range(width):
            acc = _mix(acc + ids[i: len(ids) - width + 1 + i])
        return np.unique(acc)


@lru_cache
def bands(threshold: tuple[int, int], limit: int = 1 << 40) -> list[int]:
    """Lower bounds of the size bands up to ``limit``; below the first only equal sets are
    linked. A band is at least as wide as the sizes that link over two steps."""
    p, q = threshold
    if not 0 < p < q:
        raise ValueError(f"no threshold between 0 and 1: {p}/{q}")
    up, down = (3, 2) if 3 * p * p >= 2 * q * q else (q * q, p * p)
    out = [-(-p // (q - p))]
    while out[-1] <= limit:
        out.append(out[-1] * up // down + 1)
    return out


def signatures(s: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> np.ndarray:
    """The tiles of a set: its band's parts, and those of lower bands that may hold a partner."""
    (p, q), lows, n = threshold, bands(threshold), len(s)
    j = int(np.searchsorted(lows, n, side="right")) - 1
    if j < 0:
        return np.zeros(0, np.uint64)
    levels = [j]
    while levels[-1] and p * n <= q * (lows[levels[-1]] - 1):
        levels.append(levels[-1] - 1)
    mixed, out = _mix(s + np.uint64(1)), []
    for b in levels:
        most = (lows[b + 1] - 1) * (q - p) // p  # elements in which linked sets of the band differ
        parts = most + 1 + round(8 * (most + 10) * math.exp(-p / (q - p)))
        at = (s >> np.uint64(20)) % np.uint64(parts)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, at, mixed)
        salt = np.uint64((b + 1) * int(_M2) & (1 << 64) - 1)
        tiles = _mix(total + np.arange(parts, dtype=np.uint64) * _M1 + salt)
        held = np.bincount(at.astype(np.int64), minlength=parts) > 0
        out.append(tiles[held] if held.sum() > min(most, n * (q - p) // p) else tiles)
    return np.concatenate(out)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Whether a cell holds an odd number of the elements. Shared elements cancel where two of these
    differ, so every such bit stands for an element that only one of the sets has."""
    held = np.bincount((s & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").view(np.int64)


def wide_bitmap(s: np.ndarray) -> bytes | None:
    """Such a bitmap of the power of two of bits from 2 an element on; none for sets that ``bitmap`` serves."""
    if 2 * len(s) <= 64 * WORDS:
        return None
    cells = 1 << (2 * len(s) - 1).bit_length()
    held = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").tobytes()


def bits_apart(x: bytes, y: bytes) -> int:
    """Bits in which two wide bitmaps differ, the wider one folded to the other's width."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), 0) ^ y).sum())


def describe(docs: DataFrame, shingle: int = 3, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, row, content (hash of the text), n, k1, k2 (identity of the set; null if empty),
    m0.. (bitmap), tiles, wide (bitmap of a larger set, or null)."""
    names = [f"m{i}" for i in range(WORDS)]
    arrow = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("content", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())] +
                      [(m, pa.int64()) for m in names] + [("tiles", pa.list_(pa.int64())), ("wide", pa.binary())])
    ddl = "doc_id long, row long, content long, n long, k1 long, k2 long, " + ", ".join(f"{m} long" for m in names) + ", tiles array<long>, wide binary"

    def run(batches):
        shingler = Shingler(shingle)
        for part, raws in slices(batches, 3):
            n, k1, k2, maps, offsets, tiles, wide = [], [], [], [], [0], [], []
            for raw in raws:
                s = shingler(raw)
                n.append(len(s))
                key = xxhash.xxh3_128_intdigest(s.tobytes())
                k1.append((key >> 64) - (1 << 63) if len(s) else None)
                k2.append((key & (1 << 64) - 1) - (1 << 63) if len(s) else None)
                maps.append(bitmap(s))
                wide.append(wide_bitmap(s))
                t = signatures(s, threshold)
                tiles.append(t.view(np.int64))
                offsets.append(offsets[-1] + len(t))
            m = np.stack(maps)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())] +
                [pa.array(m[:, i].copy()) for i in range(WORDS)] +
                [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(tiles))),
                 pa.array(wide, pa.binary())], schema=arrow)

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("content"),
                       "text").mapInArrow(run, ddl)


def _possible(left: str, right: str, threshold: tuple[int, int]) -> Column:
    """The bound on the overlap from above is not below what a link needs."""
    (p, q), a, b = threshold, F.col(f"{left}n"), F.col(f"{right}n")
    apart = sum((F.bit_count(F.col(f"{left}m{i}").bitwiseXOR(F.col(f"{right}m{i}"))) for i in range(1, WORDS)),
                F.bit_count(F.col(f"{left}m0").bitwiseXOR(F.col(f"{right}m0"))))
    size = F.least(a, b) * q >= F.greatest(a, b) * p
    # q * inter >= p * (a + b - inter) with inter <= (a + b - apart) / 2
    return size & ((a + b - apart) * (q + p) >= (a + b) * (2 * p))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def _texts(spark: SparkSession, docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text) of ``ids(doc_id, content, rep)``. A bitmap of bounded size drops most others
    in the scan, so that only few texts are shuffled to the exact join."""
    held = spark.sparkContext.broadcast(bitmap_of(ids.withColumn("cell", F.xxhash64("doc_id", "content")), "cell"))

    def keep(batches):
        for batch in batches:
            hit = in_bitmap(held.value, batch.column(3).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit)).select([0, 1, 2])

    some = docs.withColumn("content", F.xxhash64("text")).withColumn("cell", F.xxhash64("doc_id", "content")).select(
        "doc_id", "content", "text", "cell").mapInArrow(keep, "doc_id long, content long, text string")
    return materialize(spark, some.join(ids, ["doc_id", "content"]).select("rep", "text"), "jaccard-texts")


def screened(pairs: DataFrame, wide: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``pairs(a, b)`` without those that the bound on ``wide(rep, n, wide)`` rules out."""
    p, q = threshold

    def run(batches):
        for batch in batches:
            cols = [batch.column(i) for i in range(6)]
            sizes = zip(cols[2].to_pylist(), cols[3].to_pylist(), cols[4], cols[5])
            hit = [x is None or y is None or (x + y - bits_apart(v.as_buffer(), w.as_buffer())) * (q + p) >= (x + y) * 2 * p
                   for x, y, v, w in sizes]
            yield pa.RecordBatch.from_arrays(cols[:2], names=["a", "b"]).filter(pa.array(hit, pa.bool_()))

    both = pairs.join(wide.toDF("a", "x", "v"), "a", "left").join(wide.toDF("b", "y", "w"), "b", "left")
    return both.select("a", "b", "x", "y", "v", "w").mapInArrow(run, "a long, b long")


def _verify(spark: SparkSession, pairs: DataFrame, wide: DataFrame, docs: DataFrame, sets: DataFrame, shingle: int,
            threshold: tuple[int, int]) -> DataFrame:
    """The linked pairs (a, b) of ``pairs``, by the exact intersection of the sorted arrays."""
    pairs = materialize(spark, screened(pairs, wide, threshold), "jaccard-pairs")
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    of = sets.select("doc_id", "content", F.col("row").alias("rep")).join(wanted, "rep", "left_semi")
    texts = _texts(spark, docs, materialize(spark, of, "jaccard-wanted"))
    p, q = threshold

    def run(batches):
        shingler = Shingler(shingle)
        for part, left in slices(batches, 2):
            right, out_a, out_b, last = raw_texts(part.column(3)), [], [], (None, None)
            for i, (a, b) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                if last[0] != left[i]:
                    last = (left[i], shingler(left[i]))
                x, y = last[1], shingler(right[i])
                inter = len(np.intersect1d(x, y, assume_unique=True))
                if q * inter >= p * (len(x) + len(y) - inter) and inter:
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    both = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))
    return materialize(spark, both.mapInArrow(run, "a long, b long"), "jaccard-links")


def shared_cells(spark: SparkSession, sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(tile, rep) of the tiles that two or more distinct sets share. ``sets(row, tiles)`` holds
    every document, ``reps(rep)`` the row that stands for each distinct set."""
    wanted = spark.sparkContext.broadcast(bitmap_of(reps.select(F.xxhash64("rep").alias("h")), "h"))

    def exploded(kept=None):
        """(tile, row) of the wanted rows: cut hashes, or, with a bitmap, whole ones that it holds."""
        def run(batches):
            for batch in batches:
                batch = batch.filter(pa.array(in_bitmap(wanted.value, batch.column(1).to_numpy().view(np.uint64))))
                for at in range(0, batch.num_rows, 256):  # a row becomes hundreds
                    part = batch.slice(at, 256)
                    row = np.repeat(part.column(0).to_numpy(), pc.list_value_length(part.column(2)).to_numpy())
                    tile = part.column(2).flatten().to_numpy()
                    if kept is None:
                        tile = tile & ((1 << 40) - 1)
                    else:
                        hit = in_bitmap(kept.value, tile.view(np.uint64))
                        tile, row = tile[hit], row[hit]
                    yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(row)], names=["tile", "row"])
                pa.default_memory_pool().release_unused()

        return sets.where("n > 0").select("row", F.xxhash64("row").alias("h"), "tiles").mapInArrow(run, "tile long, row long")

    twice = exploded().groupBy("tile").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    some = exploded(spark.sparkContext.broadcast(bitmap_of(twice, "tile"))).withColumnRenamed("row", "rep").join(
        reps.select("rep"), "rep", "left_semi").distinct()
    some = materialize(spark, some, "jaccard-tiles")
    met = some.groupBy("tile").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("tile")
    return materialize(spark, some.join(met, "tile", "left_semi"), "jaccard-cells")


def open_pairs(members: DataFrame, threshold: tuple[int, int], nearest: int | None = None) -> DataFrame:
    """Pairs (a, b) of different components in a tile that the bound allows, of ``members(tile,
    rep, component, n, m0..)``. A tile is cut into blocks of about ``BLOCK`` members and every
    two blocks meet in a group of their own. With the columns of ``with_lowest`` a pair is given by
    one of its tiles (by several only if they share none of their smallest ones). With ``nearest`` a
    block meets itself and the next only, and gives each member's ``nearest`` pairs of least bits ``apart``
    and its ``DRAWN`` pairs of the least hash ``draw``."""
    (p, q), names = threshold, [f"m{i}" for i in range(WORDS)]
    lows = [c for c in (f"low{i}" for i in range(LOWEST)) if c in members.columns]
    more = lows + ["wide"] if lows else []
    blocks = members.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    cut = members.join(blocks, "tile").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    if nearest is None:
        other = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    else:  # a block is the second one of the pair with the block before it
        other = F.array_distinct(F.array("block", F.pmod(F.col("block") + 1, F.col("blocks")),
                                         F.pmod(F.col("block") - 1, F.col("blocks"))))
    cut = cut.withColumn("other", F.explode(other)).select(
        "tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "component",
        "n", *names, *more)
    dealt = cut.repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j")

    def elsewhere(tile, low, left, right):
        """Pairs that share a tile smaller than ``tile`` among the smallest ones of both."""
        out = np.zeros(len(left), bool)
        for at in range(0, len(left), 1 << 15):
            x, y = low[left[at: at + (1 << 15)]], low[right[at: at + (1 << 15)]]
            out[at: at + (1 << 15)] = ((x[:, :, None] == y[:, None, :]) & (x < tile)[:, :, None]).any((1, 2))
        return out

    def near(n, wide, left, right):
        """Pairs that the bound on the wide bitmaps doesn't rule out."""
        size = (n[left] + n[right]).tolist()
        return np.array([v is None or w is None or (s - bits_apart(v, w)) * (q + p) >= s * 2 * p
                         for s, v, w in zip(size, wide[left], wide[right])], bool)

    def first_of(value, many, left, right):
        """Pairs that are among the ``many`` of least value of one of their members."""
        out = np.zeros(len(left), bool)
        for member in (left, right):
            order = np.lexsort((value, member))
            starts = np.flatnonzero(np.r_[True, np.diff(member[order]) != 0][:len(order)])
            place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
            out[order[place < many]] = True
        return out

    def pairs(key, block, rep, component, n, maps, low=None, wide=None):
        left, right = (np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2]))
        a, b = n[left][:, None], n[right][None, :]
        apart = np.zeros((len(left), len(right)), np.int64)
        for w in range(WORDS):
            apart += np.bitwise_count(maps[w][left][:, None] ^ maps[w][right][None, :])
        ok = (np.minimum(a, b) * q >= np.maximum(a, b) * p) & ((a + b - apart) * (q + p) >= (a + b) * (2 * p))
        ok &= component[left][:, None] != component[right][None, :]
        x, y = np.nonzero(ok)
        apart = apart[x, y]
        x, y = left[x], right[y]
        if key[1] == key[2]:
            once = rep[x] < rep[y]
            x, y, apart = x[once], y[once], apart[once]
        if low is not None:
            here = ~elsewhere(key[0], low, x, y)
            x, y, apart = x[here], y[here], apart[here]
            here = near(n, wide, x, y)
            x, y, apart = x[here], y[here], apart[here]
        a, b = np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])
        if nearest is None:
            return a, b
        draw = _mix(_mix(a.view(np.uint64)) + b.view(np.uint64)).view(np.int64)  # the same in every tile
        here = first_of(apart, nearest, x, y) | first_of(draw, DRAWN, x, y)
        return a[here], b[here], apart[here], draw[here]

    def run(batches):
        held = None  # the rows of the last group may go on in the next batch
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            keys = np.stack([held.column(i).to_numpy() for i in range(3)], 1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
            yield from compared(held.slice(0, int(starts[-1])), keys, starts[:-1].tolist() + [int(starts[-1])])
            held = held.slice(int(starts[-1]))
        if held is not None:
            keys = np.stack([held.column(i).to_numpy() for i in range(3)], 1)
            yield from compared(held, keys, [0, held.num_rows])

    def compared(table, keys, bounds):
        cols = [table.column(i).to_numpy() for i in range(3, 7 + WORDS)]
        low = np.stack([table.column(c).to_numpy() for c in lows], 1) if lows else None
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            part = [c[a:b] for c in cols]
            also = () if low is None else (low[a:b], table.column("wide").slice(a, b - a).to_numpy())
            out.append(pairs(keys[a], part[0], part[1], part[2], part[3], [m.view(np.uint64) for m in part[4:]], *also))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(of)) for of in zip(*out)], names=given)

    given = ["a", "b"] if nearest is None else ["a", "b", "apart", "draw"]
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in given))


def nearest_pairs(pairs: DataFrame, nearest: int) -> DataFrame:
    """Distinct (a, b) of ``pairs(a, b, apart, draw)`` that are among the ``nearest`` of least apart
    or the ``DRAWN`` of least draw of one of their members, over all tiles: as many pairs as members
    allow, however many tiles near copies share. The drawn ones join groups whose nearest are all alike."""
    def place(value: str) -> Column:
        return F.row_number().over(Window.partitionBy("member").orderBy(value, "a", "b"))

    both = pairs.distinct().withColumn("member", F.explode(F.array("a", "b")))
    both = both.withColumn("near", place("apart")).withColumn("drawn", place("draw"))
    return both.where((F.col("near") <= nearest) | (F.col("drawn") <= DRAWN)).select("a", "b").distinct()


def with_lowest(members: DataFrame, wide: DataFrame) -> DataFrame:
    """``members(tile, rep, ...)`` with low0.. (the smallest tiles of the rep in the table, filled
    up with the greatest long) and wide, the bitmap of ``wide(rep, wide)`` folded to ``CARRIED``
    bytes at most, if the tile is one of them."""
    def fold(batches):
        for batch in batches:
            maps = [np.frombuffer(w.as_buffer(), np.uint64) for w in batch.column(1)]
            short = [m.tobytes() if m.nbytes <= CARRIED else np.bitwise_xor.reduce(m.reshape(-1, CARRIED // 8), 0).tobytes() for m in maps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary())], names=["rep", "w"])

    filled = F.array_repeat(F.lit((1 << 63) - 1).cast("long"), LOWEST)
    low = members.groupBy("rep").agg(F.concat(F.slice(F.array_sort(F.collect_set("tile")), 1, LOWEST), filled).alias("low"))
    short = low.join(wide.select("rep", "wide").mapInArrow(fold, "rep long, w binary"), "rep", "left")
    out = members.join(short, "rep")
    carried = F.when(F.array_contains(F.slice("low", 1, LOWEST), F.col("tile")), F.col("w"))
    return out.select(*members.columns, *[F.col("low")[i].alias(f"low{i}") for i in range(LOWEST)], carried.alias("wide"))


def jaccard_classes(spark: SparkSession, docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by
    links of Jaccard >= ``threshold``, a fraction (p, q))."""
    docs = pick(docs, doc_id=id_col, text=text_col)
    sets = materialize(spark, describe(docs, shingle, threshold), "jaccard-sets")
    key = ["k1", "k2", "n"]
    # a set's number is that of its smallest row: one doc_id may come with several sets
    reps = materialize(spark, sets.where("n > 0").groupBy(*key).agg(F.min("row").alias("rep")), "jaccard-reps")
    known = materialize(spark, sets.select("doc_id", *key).join(reps, key).select("doc_id", "n", "rep"), "jaccard-known")

    cells = shared_cells(spark, sets, reps)
    maps = sets.select(F.col("row").alias("id"), "n", *[f"m{i}" for i in range(WORDS)]).join(
        reps.select(F.col("rep").alias("id")), "id", "left_semi")
    maps = materialize(spark, maps, "jaccard-maps")
    wide = sets.where("wide is not null").select(F.col("row").alias("rep"), "n", "wide").join(
        cells.select("rep").distinct(), "rep", "left_semi")
    wide = materialize(spark, wide, "jaccard-wide")

    def fits(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that the bitmaps don't rule out."""
        p = pairs.join(_prefixed(maps, "a_").withColumnRenamed("a_id", "a"), "a").join(
            _prefixed(maps, "b_").withColumnRenamed("b_id", "b"), "b")
        return p.where(_possible("a_", "b_", threshold)).select("a", "b")

    # round 1: the leader that a member shares most tiles with
    lead = cells.groupBy("tile").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    pairs = cells.join(lead, "tile").where("rep > a").groupBy("a", F.col("rep").alias("b")).agg(
        F.count(F.lit(1)).alias("c"))
    best = pairs.groupBy("b").agg(F.max(F.struct("c", (-F.col("a")).alias("a"))).alias("x")).select(
        (-F.col("x.a")).alias("a"), "b")
    links = _verify(spark, fits(best), wide, docs, sets, shingle, threshold)
    first = materialize(spark, connected_components(spark, links), "jaccard-first")

    def open_members(placed: DataFrame) -> DataFrame:
        """What lies in tiles with several components of ``placed(id, component)``."""
        at = cells.join(placed.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn(
            "component", F.coalesce("component", "rep"))
        several = at.groupBy("tile").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
        at = materialize(spark, at.join(several.select("tile"), "tile", "left_semi"), "jaccard-several")
        return materialize(spark, with_lowest(at, wide).join(_prefixed(maps, "").withColumnRenamed("id", "rep"), "rep"), "jaccard-open")

    # round 2: nearest members of other components, while that joins any
    open_ = open_members(first)
    for _ in range(ROUNDS):
        near = nearest_pairs(materialize(spark, open_pairs(open_, threshold, NEAREST), "jaccard-near"), NEAREST)
        found = _verify(spark, near, wide, docs, sets, shingle, threshold)
        if found.isEmpty():
            break
        links = links.union(found)
        open_ = open_members(materialize(spark, connected_components(spark, links), "jaccard-joined"))

    # round 3: what lies in tiles with several components, against the other components
    more = materialize(spark, open_pairs(open_, threshold), "jaccard-more").distinct()
    links = links.union(_verify(spark, more, wide, docs, sets, shingle, threshold))

    # sets of one doc_id are linked; classes are named by their smallest doc_id
    several = known.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    links = links.union(known.join(several, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct())
    final = connected_components(spark, links)
    placed = known.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "doc_id", "n", F.coalesce("component", "rep").alias("class"))
    placed = materialize(spark, placed, "jaccard-placed")
    names = placed.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(names, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = sets.where("n = 0").select("doc_id", "n")
    same = out.join(none.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "component_id").distinct()
    return out.union(none.join(same, "doc_id", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id")))
