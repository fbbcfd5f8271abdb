"""Removal of repeated 200-byte strings by a common-prefix-aware distributed merge sort.

Not every suffix is sorted. A window is a 200-byte string; its anchor is the place of its
smallest hashed 100-byte gram, so equal windows have equal anchors at equal offsets. The
windows of one anchor are consecutive; the text that they cover is the anchor's unit, a
suffix cut where it stops to matter. Then:

1. hashes of the anchors' grams are counted over the corpus; a window whose anchor's gram
   is found once only can't be repeated. A bitmap of bounded size carries the repeated
   hashes to the tasks (a false hit only costs work);
2. the other units are sorted in each task into runs, front coded (length of the prefix
   shared with the string before, and the rest), exchanged by bucket and merged by a loser
   tree that keeps what prefix each string shares with the last winner and never compares
   known prefixes again. Equal units meet, byte for byte, and are repeated in full;
3. units with one anchor gram but other text around it are compared outwards from the
   gram: the stretch they share, if 200 bytes or longer, is repeated in both. Very many
   different units are dealt to blocks; what is not found repeated inside a block is
   looked for in the others by the hashes (128 bits) of its windows.

The text is read twice, and only documents with candidate units are kept for the last
step, in which their repeated bytes are removed.

Defined results: null texts count as empty; texts shorter than 200 bytes keep all bytes;
repeated rows remove each other's text; an empty table gives no rows; extra columns are
ignored."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bitmap_of, in_bitmap, materialize, pick, slices

WINDOW, GRAM = 200, 100
BLOCK = 1 << 20          # window starts looked at together
RUN_BYTES = 48 << 20     # unit text of a sorted run
PAIRWISE = 256           # different units of an anchor gram that are compared directly
FEW = 8                  # of these as bytes, two by two; more as matrices
_SEED = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_R = 0x9E3779B97F4A7C15
_M = np.uint64(0xFF51AFD7ED558CCD)
_H = np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        n = BLOCK + 2 * WINDOW
        _TABLES.append((_powers(_R, n), _powers(pow(_R, -1, 1 << 64), n)))
    return _TABLES[0]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    y = np.concatenate([x, np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(y, axis=1).ravel()
    return np.minimum(ahead[: n - w + 1], behind[w - 1: n])


def units(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The units of a text: hash of the anchor gram, first byte, length, anchor's offset."""
    out, up, down = [], *_tables()
    for at in range(0, len(raw) - WINDOW + 1, BLOCK):
        b = np.frombuffer(raw, np.uint8)[at: at + BLOCK + WINDOW - 1]
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_SEED[b] * up[: len(b)], out=total[1:])
        h = (total[GRAM:] - total[:-GRAM]) * down[: len(b) - GRAM + 1]
        h = (h ^ (h >> _H)) * _M
        h ^= h >> _H
        # upper half of the hash, then the place: the leftmost of equal ones wins
        rank = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        place = (_sliding_min(rank, WINDOW - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        stop = np.append(first[1:], len(place)) + WINDOW - 1
        out.append((h[place[first]], first + at, stop - first, place[first] - first))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out))


# ------------------------------------------------------------------ front-coded runs
def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    n, step = min(len(a), len(b)), 32
    while start < n and a[start:start + step] == b[start:start + step]:
        start += step
    if start >= n:
        return n
    x, y = a[start:start + step], b[start:start + step]
    m = min(len(x), len(y))
    diff = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
    return start + (m - (diff.bit_length() + 7) // 8 if diff else m)


def front_code(entries: list[tuple[bytes, int, int, bool]]) -> bytes:
    """A sorted run of (string, gram hash, anchor offset, found twice) as bytes."""
    keep, rest, before = [], [], b""
    for s, _, _, _ in entries:
        k = shared_prefix(before, s)
        keep.append(k)
        rest.append(s[k:])
        before = s
    head = np.array([len(entries)], "<u4").tobytes()
    cols = [np.array(keep, "<u2"), np.array([len(r) for r in rest], "<u2"), np.array([e[1] for e in entries], "<u8"),
            np.array([e[2] for e in entries], "<u2"), np.array([e[3] for e in entries], "u1")]
    return zlib.compress(head + b"".join(c.tobytes() for c in cols) + b"".join(rest), 1)


class Run:
    """Reads a front-coded run string by string."""

    def __init__(self, packed: bytes):
        raw = zlib.decompress(packed)
        n, at, cols = int(np.frombuffer(raw, "<u4", 1)[0]), 4, []
        for kind in ("<u2", "<u2", "<u8", "<u2", "u1"):
            c = np.frombuffer(raw, kind, n, at)
            cols.append(c.tolist())
            at += c.nbytes
        self.cols, self.raw, self.at, self.i, self.n = cols, raw, at, -1, n
        self.text, self.shared = b"", 0

    def advance(self) -> bool:
        self.i += 1
        if self.i >= self.n:
            return False
        self.shared, length = self.cols[0][self.i], self.cols[1][self.i]
        self.text = self.text[: self.shared] + self.raw[self.at: self.at + length]
        self.at += length
        return True

    def entry(self) -> tuple[bytes, int, int, bool]:
        return self.text, self.cols[2][self.i], self.cols[3][self.i], bool(self.cols[4][self.i])


class LoserTree:
    """Merges runs. ``shared[r]`` is what run r's string shares with the last winner; of two
    strings the one that shares more is smaller, and only equal values are compared, from
    there on."""

    def __init__(self, runs: list[Run]):
        self.runs = [r for r in runs if r.advance()]
        self.size = 1 << max(0, (len(self.runs) - 1).bit_length())
        self.done = [False] * len(self.runs) + [True] * (self.size - len(self.runs))
        self.shared = [0] * self.size
        self.loser = [-1] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, x: int, y: int) -> int:
        if self.done[y] or not self.done[x] and self.shared[x] > self.shared[y]:
            x, y = y, x  # y wins
        elif not self.done[x] and self.shared[x] == self.shared[y]:
            a, b = self.runs[x].text, self.runs[y].text
            k = shared_prefix(a, b, self.shared[x])
            if a[k:k + 1] < b[k:k + 1]:
                x, y = y, x
            self.shared[x] = k  # the loser, against the winner
        self.loser[node] = x
        return y

    def __iter__(self):
        """Entries in order, each with what it shares with the one before."""
        while self.runs and not self.done[self.winner]:
            w = self.winner
            run = self.runs[w]
            yield run.entry(), self.shared[w]
            if run.advance():
                self.shared[w] = run.shared
            else:
                self.done[w] = True
            node = (self.size + w) // 2
            while node:
                w = self._play(node, self.loser[node], w)
                node //= 2
            self.winner = w


def merged(runs: list[bytes]):
    """(string, gram hash, offset, found twice) for every different string of the runs."""
    held = None
    for (s, h, off, twice), shared in LoserTree([Run(r) for r in runs]):
        if held is not None and shared == len(s) == len(held[0]):
            held = (s, h, off, True)
            continue
        if held is not None:
            yield held
        held = (s, h, off, twice)
    if held is not None:
        yield held


# ------------------------------------------------------------------ shared stretches
def stretches(texts: list[bytes], offsets: list[int]) -> list[list[tuple[int, int]]]:
    """For units of one anchor gram: the parts of each that it shares with another one."""
    g = len(texts)
    if g <= FEW:
        parts, pairs = [(t[:o][::-1], t[o:]) for t, o in zip(texts, offsets)], [set() for _ in texts]
        for i in range(g):
            for j in range(i):
                left, right = shared_prefix(parts[i][0], parts[j][0]), shared_prefix(parts[i][1], parts[j][1])
                if left + right >= WINDOW:
                    pairs[i].add((offsets[i] - left, offsets[i] + right))
                    pairs[j].add((offsets[j] - left, offsets[j] + right))
        return [union(p) for p in pairs]
    sides = []
    for side in (0, 1):
        parts = [t[:o][::-1] if side == 0 else t[o:] for t, o in zip(texts, offsets)]
        m = np.empty((g, max(map(len, parts)) + 1), np.int32)
        m[:] = 256 + np.arange(g)[:, None]  # after the end nothing matches
        for i, p in enumerate(parts):
            m[i, : len(p)] = np.frombuffer(p, np.uint8)
        sides.append(m)
    out = []
    for i in range(g):
        left, right = ((m != m[i]).argmax(1) for m in sides)
        others = np.arange(g) != i
        found = {(offsets[i] - int(a), offsets[i] + int(b)) for a, b in zip(left[others], right[others]) if a + b >= WINDOW}
        out.append(union(found))
    return out


def union(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _name(s: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(s)
    return (x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63)


# ------------------------------------------------------------------ the Spark job
def _repeated_grams(spark: SparkSession, docs: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``1 << bits`` hash values: which gram hashes occur more than once."""
    def hashes(batches):
        for _, raws in slices(batches, 1):
            for raw in raws:
                h = units(raw)[0]
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    def joined(batches):  # few larger batches instead of one a document
        held, size = [], 0
        for b in hashes(batches):
            held.append(b.column(0))
            size += len(b)
            if size > 1 << 17:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(held)], names=["h"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(held)], names=["h"])

    twice = docs.mapInArrow(joined, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return bitmap_of(twice, "h", bits)


def _candidates(spark: SparkSession, docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """One row per document: row, doc_id, n_bytes; sha of documents without candidate units,
    raw bytes and units (first, length, offset, hash) of the others."""
    held = spark.sparkContext.broadcast(bitmap)
    arrow = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()),
                       ("raw", pa.binary()), ("units", pa.binary())])

    def run(batches):
        seen = held.value
        for part, raws in slices(batches, 2):
            rows = []
            for row, doc, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), raws):
                h, first, length, off = units(raw)
                hit = in_bitmap(seen, h)
                if hit.any():
                    packed = np.stack([first[hit], length[hit], off[hit], h[hit].view(np.int64)]).astype("<i8").tobytes()
                    rows.append((row, doc, len(raw), None, raw, packed))
                else:
                    rows.append((row, doc, len(raw), hashlib.sha256(raw).hexdigest(), None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.mapInArrow(run, "row long, doc_id long, n_bytes long, sha string, raw binary, units binary")


def _units_of(raw: bytes, packed: bytes):
    for first, length, off, h in np.frombuffer(packed, "<i8").reshape(4, -1).T.tolist():
        yield first, raw[first:first + length], off, h & (1 << 64) - 1


def _runs(candidates: DataFrame, buckets: int) -> DataFrame:
    def flush(held):
        by: dict[int, list] = {}
        for s in sorted(held):
            h, off, twice = held[s]
            by.setdefault(xxhash.xxh3_64_intdigest(s) % buckets, []).append((s, h, off, twice))
        for b, entries in by.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([front_code(entries)], pa.binary())],
                                             names=["bucket", "run"])

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for raw, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for _, s, off, h in _units_of(raw, packed):
                    old = held.get(s)
                    held[s] = (h, off, old is not None)
                    size += 0 if old else len(s) + 200
                if size > RUN_BYTES:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return candidates.where("raw is not null").select("raw", "units").mapInArrow(run, "bucket int, run binary")


def remove_repeats(spark: SparkSession, docs: DataFrame, buckets: int | None = None, bits: int = 27,
                   pairwise: int = PAIRWISE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (array of removed runs start, stop in
    bytes), kept (the remaining bytes; null where nothing is removed) and kept_sha256."""
    docs = pick(docs, doc_id=id_col, text=text_col)
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bitmap = _repeated_grams(spark, docs, bits)
    numbered = docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    cand = materialize(spark, _candidates(spark, numbered, bitmap), "suffix-candidates")

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(*_name(s), h - (1 << 64) if h >> 63 else h, off, twice, s)
                for s, h, off, twice in merged(table.column("run").to_pylist())]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), found)], schema=found)

    found = pa.schema([("u1", pa.int64()), ("u2", pa.int64()), ("h", pa.int64()), ("off", pa.int32()),
                       ("twice", pa.bool_()), ("unit", pa.binary())])
    different = materialize(spark, _runs(cand, buckets).groupBy("bucket").applyInArrow(
        merge, "u1 long, u2 long, h long, off int, twice boolean, unit binary"), "suffix-units")
    groups = different.groupBy("h").agg(F.count(F.lit(1)).alias("g"), F.min(F.col("twice").cast("int")).alias("whole"))
    groups = groups.where("g > 1 and whole = 0").drop("whole")
    mixed = different.join(groups, "h").withColumn(
        "block", F.pmod(F.col("u1"), F.expr(f"(g + {pairwise - 1}) div {pairwise}")).cast("int"))
    rows = pa.schema([("u1", pa.int64()), ("u2", pa.int64()), ("a", pa.int32()), ("b", pa.int32()),
                      ("bucket", pa.int32()), ("windows", pa.binary())])

    def compared(block: list[tuple]) -> list[tuple]:
        """Stretches (a, b) shared inside the block. For gram hashes of several blocks also the
        windows, packed by bucket: those known to be repeated once each, the others all."""
        known, out, by = set(), [], {}
        shared = stretches([r[3] for r in block], [r[1] for r in block])
        several = block[0][6] > pairwise
        for (_, _, all_, unit, u1, u2, _), spans in zip(block, shared):
            if not all_:
                out += [(u1, u2, a, b, None, None) for a, b in spans]
            if several:
                inside, at = [(0, len(unit))] if all_ else spans, 0
                for i in range(len(unit) - WINDOW + 1):
                    while at < len(inside) and inside[at][1] < i + WINDOW:
                        at += 1
                    w, found = _name(unit[i:i + WINDOW]), at < len(inside) and inside[at][0] <= i
                    if not found or w not in known:
                        by.setdefault(w[0] % buckets, []).append((*w, u1, u2, i, int(found)))
                    if found:
                        known.add(w)
        return out + [(None, None, None, None, b, zlib.compress(np.array(v, "<i8").tobytes(), 1)) for b, v in by.items()]

    def compare(batches):
        """Most gram hashes have few units: a batch holds many blocks, each from its row of place 1 on."""
        block, out = [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] == 1 and block:
                    out += compared(block)
                    block = []
                    if len(out) >= 1 << 12:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), rows)], schema=rows)
                        out = []
                block.append(row)
        out += compared(block) if block else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), rows)], schema=rows)

    place = F.row_number().over(Window.partitionBy("h", "block").orderBy("u1", "u2"))
    near = materialize(spark, mixed.select(place.alias("place"), "off", "twice", "unit", "u1", "u2", "g").mapInArrow(
        compare, "u1 long, u2 long, a int, b int, bucket int, windows binary"), "suffix-near")
    hits = pa.schema([(c, pa.int64()) for c in ("u1", "u2")] + [(c, pa.int32()) for c in ("a", "b")])

    def across(key: tuple, table: pa.Table) -> pa.Table:
        """Windows of the bucket that only another block repeats."""
        m = np.concatenate([np.frombuffer(zlib.decompress(x), "<i8").reshape(-1, 6)
                            for x in table.column("windows").to_pylist()])
        m = m[np.lexsort((m[:, 1], m[:, 0]))]
        first = np.flatnonzero(np.concatenate([[True], (m[1:, :2] != m[:-1, :2]).any(1)]))
        n = np.diff(np.append(first, len(m)))
        some = np.maximum.reduceat(m[:, 5], first)
        m = m[np.repeat((n > 1) | (some > 0), n) & (m[:, 5] == 0)]
        return pa.table([pa.array(m[:, 2]), pa.array(m[:, 3]), pa.array(m[:, 4], pa.int32()),
                         pa.array(m[:, 4] + WINDOW, pa.int32())], schema=hits)

    other = near.where("bucket is not null").groupBy("bucket").applyInArrow(across, "u1 long, u2 long, a int, b int")
    result = near.where("bucket is null").select("u1", "u2", "a", "b").union(other)
    result = result.groupBy("u1", "u2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    result = result.union(different.where("twice").select("u1", "u2", F.array(F.struct(
        F.lit(0).alias("a"), F.length("unit").alias("b"))).alias("spans")))

    def references(batches):
        for batch in batches:
            for row, raw, packed in zip(*(batch.column(c).to_pylist() for c in ("row", "raw", "units"))):
                got = [(first, *_name(s)) for first, s, _, _ in _units_of(raw, packed)]
                first, u1, u2 = zip(*got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(got), pa.int64()), pa.array(first, pa.int64()), pa.array(u1, pa.int64()),
                     pa.array(u2, pa.int64())], names=["row", "first", "u1", "u2"])

    refs = cand.where("raw is not null").select("row", "raw", "units").mapInArrow(
        references, "row long, first long, u1 long, u2 long")
    placed = F.transform("spans", lambda s: F.struct((F.col("first") + s["a"]).alias("a"), (F.col("first") + s["b"]).alias("b")))
    per = refs.join(result, ["u1", "u2"]).groupBy("row").agg(F.flatten(F.collect_list(placed)).alias("found"))
    todo = cand.where("raw is not null").select("row", "doc_id", "n_bytes", "raw").join(per, "row", "left")

    def cut(batches):
        out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct(
            [("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary()), ("kept_sha256", pa.string())])
        for batch in batches:
            found = batch.column(3)
            a, b = (found.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            ends = np.cumsum(pc.list_value_length(found).fill_null(0).to_numpy()).tolist()
            starts, stops, upto, texts, shas, last = [], [], [0], [], [], 0
            for raw, end in zip(batch.column(2).to_pylist(), ends):
                spans = union(zip(a[last:end].tolist(), b[last:end].tolist()))
                last, kept, at = end, [], 0
                for x, y in spans:
                    starts.append(x)
                    stops.append(y)
                    kept.append(raw[at:x])
                    at = y
                kept = b"".join(kept) + raw[at:]
                upto.append(len(starts))
                texts.append(kept if spans else None)
                shas.append(hashlib.sha256(kept).hexdigest())
            spans = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], ["start", "stop"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), spans),
                 pa.array(texts, pa.binary()), pa.array(shas, pa.string())], schema=out)

    ddl = "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary, kept_sha256 string"
    done = todo.select("doc_id", "n_bytes", "raw", "found").mapInArrow(cut, ddl)
    rest = cand.where("raw is null").select("doc_id", "n_bytes", F.expr(
        "cast(array() as array<struct<start: bigint, stop: bigint>>)").alias("spans"),
        F.lit(None).cast("binary").alias("kept"), F.col("sha").alias("kept_sha256"))
    return done.union(rest)
