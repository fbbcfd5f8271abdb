"""Phrase collocations from count streams in prefix and suffix order.

**Counting.** Words are counted per language. The texts are then written once as streams of
32-bit word codes, with 0 for breaks and for words below ``min_count``; no two frequent words share
a code, of whatever language (``given_codes``). A phrase as frequent as ``min_count`` has only such
parts, so order after order (2, 3, ... words) counts the windows of codes whose two shorter windows
are held by the bitmap of the order before, and leaves a bitmap of its frequent ones. Bitmaps only
rule windows out. Windows are told apart by their codes, not by hashes, so the counts are exact; the
codes of frequent windows alone are turned into words, by joins. The texts are read twice in all.

**Streams.** The frequent phrases are kept as one stream in suffix order (last word first) and
one in prefix order, cut into ranges by sampled splitters, each range sorted. Reading a range, a
stack holds the phrases that the current one starts with, so the counts of all its suffixes (in
the first stream) or prefixes (in the second) are at hand, and a one-word extension is seen
next to the phrase it extends. The two meet in lockstep: what the suffix stream found travels with
its phrase into the prefix stream. A range begins with copies of the phrases that its first
phrase starts with; a verdict reached on a copy is sent to the phrase itself. No phrase is looked
up by a hash, and a first or last word shared by any number of phrases is spread over ranges.

Every part of a phrase is at least as frequent as the phrase. So a phrase that lies inside a
longer one that is frequent enough lies inside such a phrase longer by one word, and looking at
one-word extensions decides.

Defined results: null and empty texts hold no words; a null language is ``und``; doc_ids play no
part, and repeated rows count each; ties are fixed by the order of the report; an empty table
gives no rows; extra columns are ignored."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bitmap_of, in_bitmap, materialize, pick, slices

_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
KNOWN = 200_000  # words that a task keeps with their codes
GIVEN = 1 << 24  # codes below this one are given out one by one
_M1, _M2, _S = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


def _salt(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def tokens(raw: bytes) -> list[bytes]:
    """Words of a text, with b"\\n" between pieces (and empty strings, which mean nothing)."""
    return raw.lower().translate(_BREAKS).replace(b"\n", b" \n ").split(b" ")


def windows(codes: np.ndarray, order: int, salt: int, held: list[np.ndarray]):
    """(positions, hashes) of the windows of ``order`` codes without a 0 whose two windows of
    one code less are in ``held[order - 1]``, and those of these, down to two codes."""
    at = np.flatnonzero(codes)
    wide = codes.astype(np.uint64)
    keys = _mix(wide[at] + np.uint64(salt))
    for n in range(2, order + 1):
        if n > 2:
            ok = in_bitmap(held[n - 1], keys)
            at, keys = at[ok], keys[ok]
        both = at[:-1] + 1 == at[1:]
        at, keys = at[:-1][both], _mix(keys[:-1][both] + wide[at[1:][both] + n - 2] * _M1)
    return at, keys


def merged_counts(found, limit: int = 1 << 22):
    """(keys, counts) of the uint64 arrays ``found`` of keys below 2 ** 40, merged ``limit`` at a
    time: a key and its count share a word of one buffer, which is sorted in place, so a task holds
    little more than that buffer."""
    held, size, low = np.empty(limit, np.uint64), 0, np.uint64(24)

    def out():
        part = held[:size]
        part.sort()
        keys = part >> low
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        part &= np.uint64((1 << 24) - 1)
        return keys[first].view(np.int64), np.add.reduceat(part, first).view(np.int64)

    for keys in found:
        u, c = np.unique(keys, return_counts=True)
        if len(u) and u[-1] >> np.uint64(40):
            raise ValueError("a key of more than 40 bits")
        many = c >= 1 << 24  # doesn't fit beside its key
        if many.any():
            yield u[many].view(np.int64), c[many]
            u, c = u[~many], c[~many]
        words = (u << low) | c.astype(np.uint64)
        while len(words):
            taken = min(limit - size, len(words))
            held[size: size + taken] = words[:taken]
            size, words = size + taken, words[taken:]
            if size == limit:
                yield out()
                size = 0
    if size:
        yield out()


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, c) of all words of ``docs(lang, text)``."""
    def run(batches):
        held: dict = {}
        size = 0

        def flush():
            for lang, of in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(of), pa.string()), pa.array(list(of), pa.binary()),
                                                  pa.array(list(of.values()), pa.int64())], names=["lang", "word", "c"])

        for part, raws in slices(batches, 1):
            for lang, raw in zip(part.column(0).to_pylist(), raws):
                of = held.setdefault(lang, {})
                size -= len(of)
                for w in tokens(raw):
                    of[w] = of.get(w, 0) + 1
                size += len(of)
            if size > 400_000:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    found = docs.mapInArrow(run, "lang string, word binary, c long").withColumn("word", F.col("word").cast("string"))
    return found.where(~F.col("word").isin("", "\n")).groupBy("lang", "word").agg(F.sum("c").alias("c"))


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, _salt(lang))


def _code(h: np.ndarray) -> np.ndarray:
    """32-bit code of a word's hash; 0 and the greatest are kept for breaks and for nothing, those
    below ``GIVEN`` for words that would share one."""
    return ((h >> np.uint64(32)) * np.uint64(0xFFFFFFFF - GIVEN) >> np.uint64(32)) + np.uint64(GIVEN)


def without_rare(known: dict) -> dict:
    """``known[lang][word]`` without the rare words (0), or empty if the others leave too little room."""
    some = {lang: {w: c for w, c in of.items() if c or w == b"\n"} for lang, of in known.items()}
    return some if sum(map(len, some.values())) <= KNOWN // 2 else {}


def word_codes(words: DataFrame, frequent, given=None) -> DataFrame:
    """(lang, word, c, code) of the words of ``words(lang, word, c)`` that the bitmap ``frequent`` has."""
    def run(batches):
        for batch in batches:
            langs, raw = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            h = np.array([_word_hash(lang, w) for lang, w in zip(langs, raw)], np.uint64)
            code, some = _code(h).view(np.int64), in_bitmap(frequent.value, h)
            if given is not None:
                for i in np.flatnonzero(some).tolist():
                    code[i] = given.value.get(langs[i], {}).get(raw[i], code[i])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(code)], names=["lang", "word", "c", "code"]).filter(pa.array(some))

    return words.select("lang", "word", "c").mapInArrow(run, "lang string, word string, c long, code long")


def given_codes(words: DataFrame, frequent, min_count: int) -> dict:
    """code by lang and word (bytes) for the few words that would share a frequent word's code: a
    number of its own for a frequent one, 0 for another that the bitmap lets through."""
    coded = word_codes(words, frequent)
    shared = coded.groupBy("code").agg(F.count(F.lit(1)).alias("words"), F.max("c").alias("most"))
    shared = shared.where((F.col("words") > 1) & (F.col("most") >= min_count)).select("code")
    out: dict = {}
    number = 0
    for r in sorted(coded.join(shared, "code").select("lang", "word", "c").collect()):
        number += r.c >= min_count
        out.setdefault(r.lang, {})[r.word.encode("utf-8", "surrogatepass")] = number if r.c >= min_count else 0
    if number >= GIVEN:
        raise ValueError("more frequent words than codes")
    return out


def encode(docs: DataFrame, frequent, given=None) -> DataFrame:
    """(lang, codes): the texts as little-endian unsigned 32-bit word codes, many texts in a row
    with a 0 between them; 0 for words that the bitmap ``frequent`` (a broadcast) hasn't. ``given``
    (a broadcast) holds the result of ``given_codes``."""
    def run(batches):
        known: dict = {}
        for part, raws in slices(batches, 1, limit=1 << 20, rows=512):
            of: dict = {}
            for lang, raw in zip(part.column(0).to_pylist(), raws):
                of.setdefault(lang, []).extend(tokens(raw) + [b"\n"])
            if sum(map(len, known.values())) > KNOWN:
                known = without_rare(known)
            for lang, words in of.items():
                codes = known.setdefault(lang, {b"": 0xFFFFFFFF, b"\n": 0})
                new = list(set(words).difference(codes))
                if new:
                    h = np.array([_word_hash(lang, w) for w in new], np.uint64)
                    low = _code(h)
                    codes.update(zip(new, np.where(in_bitmap(frequent.value, h), low, 0).tolist()))
                    other = given.value.get(lang, {}) if given is not None else {}
                    codes.update((w, other[w]) for w in other.keys() & new)
                out = np.fromiter(map(codes.__getitem__, words), np.uint32, len(words))
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()),
                                                  pa.array([out[out != 0xFFFFFFFF].tobytes()], pa.binary())],
                                                 names=["lang", "codes"])

    return docs.mapInArrow(run, "lang string, codes binary")


def packed(codes: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """The windows of ``order`` codes at ``at`` as uint64 columns of two codes each."""
    wide, out = codes.astype(np.uint64), []
    for j in range(0, order, 2):
        out.append(wide[at + j] << np.uint64(32))
        if j + 1 < order:
            out[-1] |= wide[at + j + 1]
    return out


def packed_keys(columns: list[np.ndarray], order: int) -> np.ndarray:
    """The hashes that ``windows`` gives the windows of these columns (with a salt of 0)."""
    keys = _mix(columns[0] >> np.uint64(32))
    for j in range(1, order):
        code = columns[j // 2] & np.uint64(0xFFFFFFFF) if j % 2 else columns[j // 2] >> np.uint64(32)
        keys = _mix(keys + code * _M1)
    return keys


def merged_windows(found, limit: int = 1 << 22):
    """(columns, counts) of the windows in ``found`` (lists of uint64 columns), merged when ``limit``
    rows are held and handed on when those are mostly different."""
    def merged(parts):
        columns = [np.concatenate(of) for of in zip(*[p[0] for p in parts])]
        counts = np.concatenate([p[1] for p in parts])
        order = np.argsort(columns[0]) if len(columns) == 1 else np.lexsort(columns[::-1])
        columns, counts = [c[order] for c in columns], counts[order]
        new = np.ones(len(counts), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        first = np.flatnonzero(new)
        return [c[first] for c in columns], np.add.reduceat(counts, first)

    held, size = [], 0
    for columns in found:
        if not len(columns[0]):
            continue
        held.append((columns, np.ones(len(columns[0]), np.int64)))
        size += len(columns[0])
        if size >= limit:
            held = [merged(held)]
            size = len(held[0][1])
            if 2 * size > limit:
                yield held[0]
                held, size = [], 0
    if held:
        yield merged(held)


def count_windows(coded: DataFrame, order: int, held) -> DataFrame:
    """(a, b, c, f): counts of the windows of ``order`` codes that ``held`` lets through, two codes
    in a column, as in ``packed`` (0 in those not needed)."""
    def run(batches):
        maps = [m and m.value for m in held]

        def found():
            for batch in batches:
                for raw in batch.column(0):
                    codes = np.frombuffer(raw.as_buffer(), np.uint32)
                    yield packed(codes, windows(codes, order, 0, maps)[0], order)

        for columns, counts in merged_windows(found()):
            for at in range(0, len(counts), 1 << 16):
                part = [c[at: at + (1 << 16)].view(np.int64) for c in columns]
                part += [np.zeros(len(part[0]), np.int64)] * (3 - len(part))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*part, counts[at: at + (1 << 16)])], names=["a", "b", "c", "f"])

    found = coded.select("codes").mapInArrow(run, "a long, b long, c long, f long")
    return found.groupBy("a", "b", "c").agg(F.sum("f").alias("f"))


def in_words(counted: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the windows ``counted(a, b, c, f)`` by ``dictionary(code, lang, word)``."""
    codes = F.array(*[x for col in ("a", "b", "c") for x in (F.shiftrightunsigned(col, 32), F.col(col).bitwiseAND(F.lit(0xFFFFFFFF)))])
    each = counted.select("a", "b", "c", "f", F.posexplode(F.filter(codes, lambda x: x != 0)).alias("at", "code"))
    words = each.join(dictionary, "code").groupBy("a", "b", "c", "f").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    return words.select("lang", F.array_join(F.col("words.word"), " ").alias("phrase"), "f")


def count_phrases(docs: DataFrame, longest: int, frequent, held) -> DataFrame:
    """(lang, phrase, f) of the phrases of 2 to ``longest`` words that the bitmaps let through, counted
    in the texts: the plain way, to compare ``count_windows`` with. Every task gives every phrase it meets."""
    def run(batches):
        words: list = [b""]  # rare words and breaks have no number of their own, and 0 for a code
        low: np.ndarray = np.zeros(1, np.uint32)
        known: dict = {}
        counted: dict = {}
        maps = [m and m.value for m in held]

        def flush():
            for lang, of in counted.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(of), pa.string()), pa.array(list(of), pa.binary()),
                                                  pa.array(list(of.values()), pa.int64())], names=["lang", "phrase", "f"])

        for part, raws in slices(batches, 1, limit=2 << 20, rows=1024):
            if sum(map(len, known.values())) > KNOWN:
                known = without_rare(known)
                if not known:
                    words, low = words[:1], low[:1]
            of: dict = {}
            for lang, raw in zip(part.column(0).to_pylist(), raws):
                of.setdefault(lang, []).extend(tokens(raw) + [b"\n"])
            for lang, all_ in of.items():
                # a frequent word's number is exact; its code only serves the bitmaps
                ids = known.setdefault(lang, {b"": -1, b"\n": 0})
                new = list(set(all_).difference(ids))
                h = np.array([_word_hash(lang, w) for w in new], np.uint64)
                some = in_bitmap(frequent.value, h)
                ids.update(zip(new, np.where(some, len(words) - 1 + np.cumsum(some), 0).tolist()))
                words += [w for w, s in zip(new, some.tolist()) if s]
                low = np.concatenate([low, _code(h[some]).astype(np.uint32)])
                number = np.fromiter(map(ids.__getitem__, all_), np.int64, len(all_))
                number = number[number >= 0]
                codes, into = low[number], counted.setdefault(lang, {})
                for n in range(2, longest + 1):
                    at, keys = windows(codes, n, _salt(lang), maps)
                    ok = in_bitmap(maps[n], keys)
                    at, keys = at[ok], keys[ok]
                    u, first, back, c = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                    like = np.ones(len(at), bool)  # has the words of the first window of its hash
                    for j in range(n):
                        like &= number[at + j] == number[at[first][back] + j]
                    c = c - np.bincount(back[~like], minlength=len(u))
                    starts = np.concatenate([at[first], at[~like]])
                    counts = np.concatenate([c, np.ones((~like).sum(), np.int64)]).tolist()
                    for row, m in zip(np.stack([number[starts + j] for j in range(n)], 1).tolist(), counts):
                        phrase = b" ".join([words[i] for i in row])
                        into[phrase] = into.get(phrase, 0) + m
            if sum(map(len, counted.values())) > 400_000:
                yield from flush()
                counted = {}
        yield from flush()

    found = docs.mapInArrow(run, "lang string, phrase binary, f long")
    return found.withColumn("phrase", F.col("phrase").cast("string")).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _hashed(counted: DataFrame, order: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            columns = [batch.column(i).to_numpy().view(np.uint64) for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(packed_keys(columns, order).view(np.int64))], names=["h"])

    return counted.select("a", "b", "c").mapInArrow(run, "h long")


def frequent_phrases(spark: SparkSession, docs: DataFrame, longest: int = 5, min_count: int = 100,
                     bits: int = 27) -> DataFrame:
    """(lang, phrase, f, n): all phrases of 1 to ``longest`` words that occur ``min_count`` times
    or more in their language, which has n words in all."""
    words = materialize(spark, count_words(docs), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("c").alias("n"))
    some = words.where(F.col("c") >= min_count)

    def hashed(batches):
        for batch in batches:
            h = [_word_hash(lang, w) for lang, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64))], names=["h"])

    of_words = some.select("lang", F.col("word").cast("binary")).mapInArrow(hashed, "h long")
    frequent = spark.sparkContext.broadcast(bitmap_of(of_words, "h", bits))
    given = spark.sparkContext.broadcast(given_codes(words, frequent, min_count))
    coded = materialize(spark, encode(docs, frequent, given), "phrase-codes")
    maps: list = [None, None]
    longer = None
    for order in range(2, longest + 1):
        counted = materialize(spark, count_windows(coded, order, list(maps)).where(F.col("f") >= min_count), "phrase-windows")
        longer = counted if longer is None else longer.union(counted)
        if order < longest:
            maps.append(spark.sparkContext.broadcast(bitmap_of(_hashed(counted, order), "h", bits)))
    longer = in_words(longer, word_codes(some, frequent, given).select("code", "lang", "word"))
    all_ = some.select("lang", F.col("word").alias("phrase"), F.col("c").alias("f")).union(longer)
    return materialize(spark, all_.join(totals, "lang"), "phrase-counts")


def _ordered(spark: SparkSession, phrases: DataFrame, backwards: bool, range_rows: int) -> DataFrame:
    """The rows of ``phrases`` as a stream in prefix (or suffix) order of their words, in ranges
    (``part``), with copies (``copy``) of what a range's first phrases start with."""
    key = F.split("phrase", " ", -1)
    keyed = phrases.withColumn("key", F.reverse(key) if backwards else key)
    parts = -(-phrases.count() // range_rows)
    each = 16
    cuts = []
    if parts > 1:
        drawn = keyed.select("lang", "key").orderBy(F.xxhash64("lang", "key"), "lang", "key").limit(each * parts).collect()
        raw = sorted((r.lang.encode(), [w.encode() for w in r.key]) for r in drawn)
        cuts = raw[each::each]
    starts_with: dict = {}
    for i, (lang, words) in enumerate(cuts):
        for n in range(1, len(words)):
            starts_with.setdefault((lang, tuple(words[:n])), []).append(i + 1)

    def run(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            keys = batch.column(1).to_pylist()
            rows, part, copy = [], [], []
            for i, (lang, words) in enumerate(zip(langs, keys)):
                at = (lang.encode(), [w.encode() for w in words])
                home = bisect.bisect_right(cuts, at)
                more = [p for p in starts_with.get((at[0], tuple(at[1])), ()) if p > home]
                rows += [i] * (1 + len(more))
                part += [home] + more
                copy += [False] + [True] * len(more)
            wide = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*wide.columns, pa.array(part, pa.int32()), pa.array(copy, pa.bool_())],
                                             names=[*wide.schema.names, "part", "copy"])

    rest = [c for c in phrases.columns if c != "lang"]
    keyed = keyed.select("lang", "key", *rest)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema.fields)
    cut = keyed.mapInArrow(run, ddl + ", part int, copy boolean")
    return cut.repartitionByRange(max(parts, 1), "part").sortWithinPartitions("part", "lang", "key")


def _stacked(batches, columns: list[str], percent: int):
    """Rows (dicts) of a sorted range with ``above``: the counts of what they start with, shortest
    first; yielded when no extension can follow, with ``dropped`` set by a one-word extension
    that has ``percent`` of the row's count or more."""
    stack: list = []
    last = None
    for batch in batches:
        for values in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
            row = dict(zip(columns, values))
            if (row["part"], row["lang"]) != last:
                while stack:
                    yield stack.pop()
                last = (row["part"], row["lang"])
            key = row["key"]
            while stack and (len(stack[-1]["key"]) >= len(key) or key[:len(stack[-1]["key"])] != stack[-1]["key"]):
                yield stack.pop()
            if len(stack) != len(key) - 1:
                raise ValueError(f"{row['lang']}: a part of {key} is missing from the stream")
            row["above"] = [s["f"] for s in stack]
            if stack and 100 * row["f"] >= percent * stack[-1]["f"]:
                stack[-1]["dropped"] = True
            stack.append(row)
    while stack:
        yield stack.pop()


def _blocks(rows, arrays, limit: int = 20_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield arrays(held)
            held = []
    if held:
        yield arrays(held)


def collocations(spark: SparkSession, docs: DataFrame, longest: int = 5, min_count: int = 100, top: int = 2000,
                 contained_percent: int = 100, factor: int = 1000, lang_col: str = "lang", text_col: str = "text",
                 range_rows: int = 500_000, bits: int = 27) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language, by the lowest
    floor(factor * a * n / (l * r)) over the cuts of a phrase in two."""
    d = pick(docs, lang=lang_col, text=text_col).withColumn("lang", F.coalesce("lang", F.lit("und")))
    counts = frequent_phrases(spark, d, longest, min_count, bits)

    # suffix order: counts of the right parts of every cut, extensions to the left
    columns = ["lang", "key", "phrase", "f", "n", "part", "copy"]

    def right(batches):
        def arrays(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r["lang"] for r in rows]), pa.array([r["phrase"] for r in rows]),
                 pa.array([r["f"] for r in rows], pa.int64()), pa.array([r["n"] for r in rows], pa.int64()),
                 pa.array([r["above"] for r in rows], pa.list_(pa.int64())),
                 pa.array([r.get("dropped", False) for r in rows]), pa.array([r["copy"] for r in rows])],
                names=["lang", "phrase", "f", "n", "rights", "dropped", "copy"])
        # a copy that no extension dropped has nothing to say
        return _blocks((r for r in _stacked(batches, columns, contained_percent) if not r["copy"] or r.get("dropped")), arrays)

    suffixes = materialize(spark, _ordered(spark, counts, True, range_rows).mapInArrow(
        right, "lang string, phrase string, f long, n long, rights array<long>, dropped boolean, copy boolean"), "phrase-suffixes")
    own = suffixes.where("not copy").drop("copy").withColumnRenamed("dropped", "gone")

    # prefix order: counts of the left parts, extensions to the right, and the score
    wide = ["lang", "key", "phrase", "f", "n", "rights", "gone", "part", "copy"]

    def left(batches):
        def scored(row):
            best = (0, 0, 0)
            for k, l in enumerate(row["above"]):
                # the part after the first k + 1 words is the suffix of as many words as remain
                r = row["rights"][len(row["above"]) - 1 - k]
                score = factor * row["f"] * row["n"] // (l * r)
                if not k or score < best[0]:
                    best = (score, l, r)
            return best

        def arrays(rows):
            best = [scored(r) for r in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([r["lang"] for r in rows]), pa.array([r["phrase"] for r in rows]),
                 pa.array([r["f"] for r in rows], pa.int64()), pa.array([b[1] for b in best], pa.int64()),
                 pa.array([b[2] for b in best], pa.int64()), pa.array([r["n"] for r in rows], pa.int64()),
                 pa.array([b[0] for b in best], pa.int64()),
                 pa.array([bool(r.get("dropped") or r["gone"]) for r in rows]), pa.array([r["copy"] for r in rows])],
                names=["lang", "phrase", "a", "l", "r", "n", "score", "dropped", "copy"])
        return _blocks((r for r in _stacked(batches, wide, contained_percent)
                        if len(r["key"]) > 1 and (not r["copy"] or r.get("dropped"))), arrays)

    scored = materialize(spark, _ordered(spark, own, False, range_rows).mapInArrow(
        left, "lang string, phrase string, a long, l long, r long, n long, score long, dropped boolean, copy boolean"), "phrase-scores")
    gone = suffixes.where("copy").select("lang", "phrase").union(scored.where("copy").select("lang", "phrase")).distinct()
    left_over = scored.where("not copy and not dropped").drop("dropped", "copy").join(gone, ["lang", "phrase"], "left_anti")

    # ranks inside salted parts of a language first: no task sees more than `top` rows of each
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = left_over.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
