"""Token ids in ORC files, in ascending document order.

The documents are range-partitioned and sorted by id, so file after file holds ascending ids.
A row has doc_id, n_tokens, the ids as a list of integers (ORC's integer run-length encoding),
the number of its file and its start inside the file. Files are cut into stripes, which Spark
reads in parallel; each stripe carries row indexes (least and greatest value of every
``row_index`` rows) and Bloom filters on doc_id, by which a read of a few documents skips
stripes and row groups. The start over all documents is the file's base, a prefix sum of one
number per file, plus the start inside the file: no document is counted twice or in one task.

Ids are those of the ``tokenizers`` library. White space never enters a token of this kind of
vocabulary (``[^\\s...]`` in its splitting pattern, special tokens without white space), so a
text is encoded word by word and the words' ids are kept in a bounded table; each distinct word
of some megabytes of text is looked up once. Words of plain Latin letters, and those before a run
of marks, go straight to the library's model (lower case and the byte alphabet are all that its
normaliser and splitter do to them); every other word and every run of marks goes through the
whole tokenizer.

Defined results: a null or empty text has the end id only; a null doc_id comes first; rows with
one doc_id follow each other by a hash of the text; repeated rows are written each; an empty
table gives no rows; extra columns are ignored."""

from __future__ import annotations

import re
import zlib
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .best_fit import _byte_letters
from .common import pick, slices

SCHEMA = "doc_id long, n_tokens long, file int, first long, ids array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.int32()), ("first", pa.int64()),
                    ("ids", pa.list_(pa.int32()))])
_LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\\[-`{-~]*)")  # no apostrophe, and no < of a special token
_ENCODERS: dict = {}


class WordEncoder:
    """ids of texts. About ``limit`` words are kept: when half of that have been met, they become
    the older half, from which words that come again return."""

    def __init__(self, vocabulary: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.limit, self.known, self.older = Tokenizer.from_file(vocabulary), limit, {}, {}
        self.letters = _byte_letters()

    def _learn(self, words: list[bytes]) -> None:
        known, older, bases, ended, rest = self.known, self.older, set(), [], []
        for w in words:
            m = _LATIN.fullmatch(w.decode("utf-8", "replace"))
            if m is None:
                rest.append(w)
                continue
            base = m[1].lower().encode()
            if base in older:
                known[base] = older[base]
            elif base not in known:
                bases.add(base)
            if base != w:  # marks after the letters are a piece of their own to the splitter
                ended.append((w, base, m[2].encode()))
        marks = {mark for _, _, mark in ended if mark}.difference(known)
        known.update((mark, older[mark]) for mark in marks if mark in older)
        rest += marks.difference(known, rest)
        tokenize = self.tokenizer.model.tokenize
        for w in bases:
            s = w.decode("latin-1")
            ids = [t.id for t in tokenize(s if w.isascii() else s.translate(self.letters))]
            known[w] = pack(f"<{len(ids)}I", *ids)
        for w in rest:  # a batch would start threads in every worker
            ids = self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids
            known[w] = pack(f"<{len(ids)}I", *ids)
        for w, base, mark in ended:
            known[w] = known[base] + known[mark] if mark else known[base]

    def flat(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and their number text by text. A word is looked up once
        a call, however often it comes."""
        if len(self.known) > self.limit // 2:
            self.known, self.older = {}, self.known
        raw = pa.array(raws, pa.binary())
        lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(raw), raw.buffers()))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        known, older = self.known, self.older
        new = [w for w in words if w not in known]
        known.update((w, older[w]) for w in new if w in older)
        self._learn([w for w in new if w and w not in known])
        ids = [known[w] if w else b"" for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        code = coded.indices.to_numpy()
        n = sizes[code]
        ends = np.cumsum(n)
        at = np.arange(n.sum()) + np.repeat((np.cumsum(sizes) - sizes)[code] - ends + n, n)
        return np.frombuffer(b"".join(ids), "<u4")[at], np.diff(np.r_[0, ends][lists.offsets.to_numpy()])

    def __call__(self, raws: list[bytes]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit bytes."""
        ids, sizes = self.flat(raws)
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def word_encoder(vocabulary: str) -> WordEncoder:
    """One per worker process: later tasks of the process find the words it has met."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", files: int | None = None, stripe_bytes: int = 64 << 20,
                 row_index: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Writes the ids of every whole text and ``end_id`` after each. ``files`` fixes the number
    of files; by default the shuffle's partitions, joined to a fair size by AQE, decide."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("tie", F.xxhash64("text"))
    by = ["doc_id", "tie"]
    d = (d.repartitionByRange(files, *by) if files else d.repartitionByRange(*by)).sortWithinPartitions(*by)

    def run(batches):
        encode, number, first = word_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for part, raws in slices(batches, 1, limit=6 << 20, rows=8192):
            ids, sizes = encode.flat(raws)
            ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<i4")
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(np.full(len(sizes), number, np.int32)),
                 pa.array(first + ends - sizes),
                 pa.ListArray.from_arrays(offsets, pa.array(ids))], schema=_ARROW)
            first += int(ends[-1])

    (d.select("doc_id", "text").mapInArrow(run, SCHEMA).write
     .option("orc.stripe.size", stripe_bytes).option("orc.create.index", "true")
     .option("orc.row.index.stride", row_index).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", bloom_fpp).orc(path))


def file_bases(spark: SparkSession, path: str) -> DataFrame:
    """(file, base): the ids in all earlier files. One row per file; reads two columns."""
    sizes = spark.read.schema(SCHEMA).orc(path).groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids. With ``doc_ids`` only
    those: the filter goes to the files' row indexes and Bloom filters. The bases are broadcast:
    16 bytes a file, and a table's file list is held by the driver anyway."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    return rows.join(F.broadcast(file_bases(spark, path)), "file").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (unsigned, of the ids as little-endian 32-bit) of
    rows of ``read_tokens``."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            raw = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False), "<i4")).cast("B")
            ends = 4 * np.concatenate([[0], np.cumsum(batch.column(2).to_numpy())])
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array(crc, pa.int64())], schema=schema)

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
