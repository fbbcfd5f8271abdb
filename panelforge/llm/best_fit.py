"""Best-fit-decreasing packing of tokenised documents into sequences.

Documents are tokenised in Arrow batches and the pieces written once. Best fit decreasing
looks only at lengths, and lengths lie between 1 and the capacity, so the global packing
is decided on the histogram of lengths (at most ``capacity`` rows): bins with the same
history are one entry with a count, held by remaining capacity under a segment tree that
finds the tightest open remainder in logarithmic time. The result is a bounded table of
slots per length; every piece finds its slot from its number among the pieces of its
length, which Spark computes without gathering a length in one task.

Defined results: null text counts as empty; an empty document is its end token alone, one
piece of length 1; an empty table gives no rows; repeated rows are packed each; columns
beyond the named ones are ignored."""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, number_within, pick

_ENCODERS: dict = {}


def encoder(path: str):
    """Byte-level BPE of the vocabulary file at ``path`` (``.json`` of ``tokenizers`` or
    ranks ``.tiktoken``). The merge ranks of the json are its ids, so ``token_ids`` gives those of
    ``tokenizers`` with add_special_tokens=False; the rank form runs several times faster."""
    if path not in _ENCODERS:
        import tiktoken
        from public_tokenizers import PATTERN
        special = {}
        if path.endswith(".json"):
            import json
            with open(path, encoding="utf-8") as f:
                whole = json.load(f)
            model, special = whole["model"], {t["content"]: t["id"] for t in whole["added_tokens"]}
            back = {c: b for b, c in _byte_letters().items()}
            ranks = {bytes(back[c] for c in tok): i for tok, i in model["vocab"].items()
                     if all(c in back for c in tok) and tok not in special}
        else:
            import base64
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def token_ids(enc, text: str) -> list[int]:
    """Ids of a text; a special token's string in it is that token."""
    return enc.encode(text, allowed_special="all") if "<|" in text else enc.encode_ordinary(text)


def _byte_letters() -> dict[int, str]:
    """The published byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def tokenize(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: (doc_id, piece, start, length, ids), ids as
    little-endian unsigned 32-bit. A document is its ids and then ``end_id``; only longer
    ones are cut, the first piece taking what the full ones leave over."""
    schema = "doc_id long, piece int, start long, length long, ids binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                       ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            rows, size = ([], [], [], [], []), 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = token_ids(enc, text.as_py() or "")
                ids.append(end_id)
                raw, n, start, piece = np.array(ids, dtype="<u4").tobytes(), len(ids), 0, 0
                while start < n:
                    length = (n - start - 1) % capacity + 1 if start == 0 else capacity
                    for col, v in zip(rows, (doc, piece, start, length, raw[4 * start: 4 * (start + length)])):
                        col.append(v)
                    start, piece = start + length, piece + 1
                size += len(raw)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, arrow)], schema=arrow)
                    rows, size = ([], [], [], [], []), 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, arrow)], schema=arrow)

    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(run, schema)


class TightestFit:
    """Segment tree over remaining capacities 0..n: the smallest open remainder >= want."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, remainder: int, is_open: bool) -> None:
        i = self.leaves + remainder
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def find(self, want: int) -> int:
        """-1 when nothing fits."""
        i = self.leaves + want
        if self.open[i]:
            return want
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return -1
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing of ``histogram`` (length -> count). Returns slots (length, first,
    bin, per_bin, offset): the pieces of that length numbered from ``first`` go to bins
    from ``bin`` on, ``per_bin`` side by side in each from ``offset``.

    Equal lengths are placed together: the tightest bin that takes one piece stays the
    tightest until it takes no more, so a run of n equal bins takes floor(rest / length)
    pieces each. A step splits at most one run, which bounds runs and slots by the number
    of lengths, whatever the number of documents."""
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remainder -> [(first bin, bins)]
    tree, slots, bins = TightestFit(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        while left:
            rest = tree.find(length)
            if rest < 0:
                rest, each = capacity, capacity // length
                start, n = bins, -(-left // each)
                bins += n
            else:
                start, n = runs[rest].pop()
                each = rest // length
                if not runs[rest]:
                    tree.set(rest, False)
            full = min(n, left // each)
            last = left - full * each if full < n else 0  # pieces in one more bin of the run
            slots.append((length, first, start, each, capacity - rest))
            placed = full * each + last
            after = [(start, full, rest - each * length), (start + full, 1 if last else 0, rest - last * length),
                     (start + full + (1 if last else 0), n - full - (1 if last else 0), rest)]
            for begin, count, rem in after:
                if count and rem:
                    runs[rem].append((begin, count))
                    tree.set(rem, True)
            left, first = left - placed, first + placed
    return slots


def place(pieces: DataFrame, slots: list[tuple[int, int, int, int, int]], number: str = "n") -> DataFrame:
    """Adds sequence_id and offset from the slot that holds piece ``number`` of its length."""
    by = defaultdict(lambda: ([], [], [], []))
    for length, first, start, each, offset in slots:
        for col, v in zip(by[length], (first, start, each, offset)):
            col.append(v)
    tables = {k: tuple(np.array(c, dtype="i8") for c in v) for k, v in by.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, n: pd.Series) -> pd.DataFrame:
        seq, off = np.zeros(len(n), "i8"), np.zeros(len(n), "i8")
        lens, nums = length.to_numpy(), n.to_numpy()
        for k in np.unique(lens):
            at = np.flatnonzero(lens == k)
            first, start, each, offset = tables[int(k)]
            i = np.searchsorted(first, nums[at], side="right") - 1
            d = nums[at] - first[i]
            seq[at], off[at] = start[i] + d // each[i], offset[i] + (d % each[i]) * k
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return (pieces.withColumn("slot__", slot("length", number))
            .select(*pieces.columns, "slot__.sequence_id", "slot__.offset"))


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0,
         buckets: int = 64, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Returns (pieces, placement). ``pieces`` is the written token table of ``tokenize``;
    ``placement`` has one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    pieces = materialize(spark, tokenize(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces")
    keys = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    histogram = {r["length"]: r["n"] for r in keys.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    numbered = number_within(keys, "length", ["doc_id", "piece", "ids_crc32"], "n", buckets)
    return pieces, place(numbered, plan(histogram, capacity)).drop("n")


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing has fewer sequences (used by the tests): pieces over half a sequence each
    need their own, and all tokens need room."""
    ordered = sorted(lengths)
    return max(-(-sum(ordered) // capacity), len(ordered) - bisect.bisect_right(ordered, capacity // 2))
