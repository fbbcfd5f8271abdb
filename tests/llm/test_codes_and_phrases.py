"""Token files, vector codes and collocations against brute force."""

import glob
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.orc
import pytest

from panelforge.llm import collocations, laesa_codes, orc_tokens

DDL = "doc_id long, text string, lang string, Text int, DOC_ID string, first int, key int"


def _vocabulary():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(_vocabulary())


def _rows():
    rng = random.Random(3)
    odd = [None, "", " \t\n", "Hello, World. it's I'D <|endoftext|> x<|ENDOFTEXT|>. <|startoftext|>,", "H̱ é É. ß, Σας ǆ İ",
           "a\x1cb\x85c\xa0d e, f", "日本語 🙂. x", "a., b.. c ,. \"d,\" e,\nf.", "１２ 12 x2y", "\x00 \x01a",
           "word " * 30_000, "x" * 5_000]
    words = ["".join(rng.choice("abcdeéÖ,.'") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    odd += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    rows = [(i, t, ("en", "fr", None, "")[i % 4], 1, "x", 2, 3) for i, t in enumerate(odd)]
    return rows + [(None, "no id", "en", 1, "y", 2, 3), (5, "second text", "en", 1, "y", 2, 3), rows[20]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


# ------------------------------------------------------------------ 11
def test_orc_tokens_round_trip(spark, docs, tmpdir_path):
    path = tmpdir_path + "/tokens"
    orc_tokens.write_tokens(docs, path, _vocabulary(), files=4)
    tok = _tokenizer()
    want = Counter()
    for r in _rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want[r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = orc_tokens.checksums(orc_tokens.read_tokens(spark, path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (r.doc_id is None and at == 0 or r.doc_id >= last)
        at, last = at + r.n_tokens, last if r.doc_id is None else r.doc_id
    assert len(glob.glob(path + "/*.orc")) == 4


def test_orc_stripes_index_and_bloom_filter(spark, tmpdir_path):
    path = tmpdir_path + "/tokens"
    rng = random.Random(5)
    some = spark.createDataFrame([(3 * i, " ".join(str(rng.random()) for _ in range(40)), "en", 1, "x", 2, 3)
                                  for i in range(12_000)], DDL)
    orc_tokens.write_tokens(some, path, _vocabulary(), files=1, stripe_bytes=256 << 10, row_index=1000)
    (file,) = glob.glob(path + "/*.orc")
    read = pyarrow.orc.ORCFile(file)
    assert read.nstripes > 1 and read.file_version == "0.12"  # 0.12: run-length encoding, version 2
    parts = [read.read_stripe(i).column("doc_id").to_pylist() for i in range(read.nstripes)]
    assert sum(parts, []) == [3 * i for i in range(12_000)]
    jvm = spark._jvm
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(
        spark._jsc.hadoopConfiguration()))
    stripe = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {str(s.getKind()) for s in stripe.getStreamsList()}
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds
    assert {str(c.getKind()) for c in list(stripe.getColumnsList())[1:]} >= {"DIRECT_V2"}

    def rows_read(ids):
        one = spark.read.schema(orc_tokens.SCHEMA).orc(path).where(f"doc_id in ({ids})").select("doc_id")
        found = one.count()
        one.collect()
        plan = one._jdf.queryExecution().executedPlan()
        return found, plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    assert rows_read("6000") == (1, 1000)  # a row group by the row index
    assert rows_read("6001") == (0, 0)     # inside its range, but not in the Bloom filter
    got = orc_tokens.read_tokens(spark, path, [6000, 6001, 9]).collect()
    want = {r.doc_id: r for r in orc_tokens.read_tokens(spark, path).where("doc_id in (9, 6000)").collect()}
    assert {r.doc_id: r for r in got} == want and len(want) == 2


def test_orc_tokens_of_nothing(spark, empty, tmpdir_path):
    orc_tokens.write_tokens(empty, tmpdir_path + "/none", _vocabulary())
    assert orc_tokens.checksums(orc_tokens.read_tokens(spark, tmpdir_path + "/none")).count() == 0


def test_word_table_is_bounded():
    encode = orc_tokens.WordEncoder(_vocabulary(), limit=3)
    for text in ("a b c d e", "f g", "a f"):
        encode([text.encode()])
        assert len(encode.known) <= 5 + 2  # and the two stops


def test_words_with_marks_and_returning_words_are_not_encoded_anew(monkeypatch):
    """Only words of other kinds and runs of marks go through the whole tokenizer; a word that comes
    again stays known when others are dropped."""
    encode, tok = orc_tokens.WordEncoder(_vocabulary(), limit=40), _tokenizer()
    asked = []

    class Counting:
        model = encode.tokenizer.model

        def __getattr__(self, name):
            return lambda text, **kw: asked.append(text) or getattr(tok, name)(text, **kw)

    encode.tokenizer = Counting()
    texts = [f"hé{'abcdefghij'[k % 10] * (k // 10 + 1)}*** Élan!! again. x<|endoftext|>. it's" for k in range(200)]
    for k in range(0, 200, 5):
        for text, got in zip(texts[k:], encode([t.encode() for t in texts[k:k + 5]])):
            assert np.frombuffer(got, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted(["***", "!!", ".", "x<|endoftext|>.", "it's"])


# ------------------------------------------------------------------ 12
VECTORS = "vec_id long, embedding array<double>, label string, Embedding int, VEC_ID string, codes int"


def _vectors():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 16)) * 3) / 64  # a coarse grid: ties
    rows = [(int(i), [float(v) for v in row], f"l{i % 3}" if i % 5 else None, 1, "x", 2) for i, row in enumerate(x)]
    rows += [(7, rows[7][1], "l1", 1, "x", 2), (3, [0.5] * 16, "l0", 1, "x", 2), (None, rows[9][1], "l2", 1, "x", 2),
             (900, None, "l0", 1, "x", 2), (901, [None] * 16, "l0", 1, "x", 2), (902, [float("nan")] * 16, "l0", 1, "x", 2),
             (903, [float("-inf")] + [0.0] * 15, "l0", 1, "x", 2), (904, [], "l1", 1, "x", 2), (905, [1.0] * 24, "l1", 1, "x", 2)]
    return rows


def _brute(rows, parts, entries, rounds):
    kept = [(r[0], np.floor(np.array(r[1]) * 4096).astype(int)) for r in rows
            if r[1] and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all()]
    seeds = {}
    for i, v in kept:
        if i is not None:
            seeds[i] = min(seeds.get(i, v.tolist()), v.tolist())
    books = [[np.array(seeds[i])[w:w + 16 // parts] for i in sorted(seeds)[:entries]] for w in range(0, 16, 16 // parts)]
    out = None
    for r in range(rounds + 1):
        out = []
        for i, v in kept:
            pieces = [v[w:w + 16 // parts] for w in range(0, 16, 16 // parts)]
            out.append([min((int(((x - e) ** 2).sum()), k) for k, e in enumerate(b)) for x, b in zip(pieces, books)])
        if r < rounds:
            for p, b in enumerate(books):
                for k in range(len(b)):
                    own = [v[p * 16 // parts:(p + 1) * 16 // parts] for (_, v), o in zip(kept, out) if o[p][1] == k]
                    if own:
                        b[k] = np.array([sum(int(x[c]) for x in own) // len(own) for c in range(16 // parts)])
    return Counter((i, tuple(k for _, k in o), sum(d for d, _ in o)) for (i, _), o in zip(kept, out)), books


@pytest.mark.parametrize("entries, pivots", [(16, 4), (5, 1), (400, 3)])
def test_codes_equal_full_search(spark, entries, pivots):
    df = spark.createDataFrame(_vectors(), VECTORS).repartition(4)
    coded, books = laesa_codes.compress(spark, df, parts=4, entries=entries, rounds=3, pivots=pivots)
    want, want_books = _brute(_vectors(), 4, entries, 3)
    rows = coded.collect()
    assert Counter((r.vec_id, tuple(r.codes), r.error) for r in rows if r.codes) == want
    assert [b.tolist() for b in books] == [[e.tolist() for e in b] for b in want_books]
    assert {r.vec_id for r in rows if r.codes is None} == {904, 905}
    if entries == 16:  # the bounds spare evaluations
        assert sum(r.evaluated for r in rows if r.codes) < 0.8 * 16 * 4 * sum(want.values())


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(8)
    for _ in range(50):
        x = rng.integers(-40, 40, (200, 3)) * rng.integers(1, 3000)
        entries = x[rng.integers(0, 200, 12)] + rng.integers(-2, 3, (12, 3))
        pivots = laesa_codes.choose_pivots(entries, 3)
        at, best, tried = laesa_codes.nearest(x, laesa_codes.root(laesa_codes.distances(x, pivots)), entries, pivots)
        full = laesa_codes.distances(x, entries)
        assert (at == full.argmin(1)).all() and (best == full.min(1)).all() and tried.max() <= 12
    big = np.array([0, 1, 2, 3, 4, (1 << 62) - 1, 1 << 62, (3037000499) ** 2, 3037000499 ** 2 - 1])
    assert laesa_codes.root(big).tolist() == [math.isqrt(v) for v in big.tolist()]


def test_codes_of_nothing_and_of_too_much(spark):
    none = spark.createDataFrame([], VECTORS)
    assert laesa_codes.compress(spark, none)[0].count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 7, "a", 1, "x", 2)], VECTORS)
    coded, books = laesa_codes.compress(spark, odd)
    assert [(r.vec_id, r.codes) for r in coded.collect()] == [(1, None)] and books == []
    huge = spark.createDataFrame([(1, [1e30] * 8, "a", 1, "x", 2)], VECTORS)
    with pytest.raises(ValueError, match="64 bits"):
        laesa_codes.compress(spark, huge)


# ------------------------------------------------------------------ 13
def _phrases(rows, least, percent, top):
    f, n = Counter(), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, g), a in cand.items():
        inside = any(100 * b >= percent * a and len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h)))
                     for (m, h), b in cand.items() if m == lang)
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]], n[lang]))
    return {(lang, i + 1, p.decode(), -a, l, r, total, -s) for lang, rows in out.items()
            for i, (s, a, p, l, r, total) in enumerate(sorted(rows)[:top])}


def _phrase_rows():
    rng = random.Random(6)
    words = ["the", "The", "of", "a\x01", "a", "é", "É", "b", "c d", "zz", "new", "york"]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", "", ",", "\n", "\t", ". "]) for _ in range(rng.randint(0, 60)))
        text += " the new york times of" * rng.randint(0, 2) + " rare%d" % i
        rows.append((i, text, ("en", "en", "en", "fr", None)[i % 5], 1, "x", 2, 3))
    return rows + [(1, None, "en", 1, "x", 2, 3), (2, "", None, 1, "x", 2, 3), rows[3], rows[3]]


@pytest.mark.parametrize("percent, top, range_rows, bits", [(100, 2000, 10, 27), (60, 7, 1_000_000, 27), (100, 50, 37, 8)])
def test_collocations_equal_brute_force(spark, percent, top, range_rows, bits):
    """Ranges of a few rows; bitmaps so small that nearly all bits are set."""
    df = spark.createDataFrame(_phrase_rows(), DDL).repartition(3)
    got = collocations.collocations(spark, df, min_count=6, top=top, contained_percent=percent, range_rows=range_rows, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == _phrases(_phrase_rows(), 6, percent, top)


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(spark, empty).count() == 0


def test_collocations_of_a_long_text(spark):
    rows = [(1, "one two three " * 40_000, "en", 1, "x", 2, 3), (2, "one two", "en", 1, "x", 2, 3)]
    got = {r.phrase: r for r in collocations.collocations(spark, spark.createDataFrame(rows, DDL)).collect()}
    assert got["one two three one two"].a == 39_999 and "two three" not in got and "three one" not in got


def test_hash_counts_are_merged_in_little_memory():
    import tracemalloc
    rng = np.random.default_rng(24)
    keys = [rng.integers(0, 1 << 40, 20_000, np.uint64) >> np.uint64(rng.integers(0, 30)) for _ in range(60)]
    want = dict(zip(*(x.tolist() for x in np.unique(np.concatenate(keys), return_counts=True))))
    for limit in (1 << 18, 999):
        got = {}
        for u, c in collocations.merged_counts(iter(keys), limit):
            for k, n in zip(u.tolist(), c.tolist()):
                got[k] = got.get(k, 0) + n
        assert got == want
    many = np.full((1 << 24) + 3, 7, np.uint64)
    assert [(u.tolist(), c.tolist()) for u, c in collocations.merged_counts(iter([many]), 10)] == [([7], [len(many)])]
    rows = (rng.integers(0, 1 << 40, 1 << 14, np.uint64) for _ in range(64))
    tracemalloc.start()
    for _ in collocations.merged_counts(rows, 1 << 20):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 8 << 20, peak      # lists of keys and counts, merged by inverse: 11 words a key


@pytest.mark.parametrize("known", [3, 40, 200_000])
def test_phrase_counts_keep_few_words(spark, monkeypatch, known):
    """Rare words are dropped when a task has met many, frequent ones stay while there is room."""
    monkeypatch.setattr(collocations, "KNOWN", known)
    df = spark.createDataFrame(_phrase_rows(), DDL).repartition(2)
    got = collocations.collocations(spark, df, min_count=6)
    assert {tuple(r) for r in got.collect()} == _phrases(_phrase_rows(), 6, 100, 2000)


def test_a_task_of_many_words_takes_little_memory(monkeypatch):
    import tracemalloc

    class Held:
        value = np.zeros(1 << 14, np.uint64)

    class Frame:  # the function given to mapInArrow, run here
        def mapInArrow(self, run, ddl):
            batches = (pyarrow.RecordBatch.from_arrays([pyarrow.array(["en"] * 50), pyarrow.array(
                [" ".join("w%d" % (k * 50_000 + i * 1000 + j) for j in range(1000)) for i in range(50)])], names=["lang", "text"])
                for k in range(9))
            tracemalloc.start()
            for _ in run(batches):
                pass
            self.peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            raise StopIteration

    for step in (lambda f: collocations.count_phrases(f, 5, Held, [None, None] + [Held] * 4), lambda f: collocations.encode(f, Held)):
        frame = Frame()
        with pytest.raises(StopIteration):
            step(frame)
        assert frame.peak < 45 << 20, frame.peak >> 20


def test_frequent_phrases_are_not_sent_by_every_task(spark, monkeypatch):
    """The texts aren't read again for the phrases: one row of codes for each comes to the words."""
    asked, first = [], getattr(collocations, "in_words", None)

    def plain(*a):
        raise AssertionError("a row for each phrase and task")

    monkeypatch.setattr(collocations, "count_phrases", plain)
    monkeypatch.setattr(collocations, "in_words", lambda counted, *a: asked.append(counted) or first(counted, *a), raising=False)
    rows = _phrase_rows()
    df = spark.createDataFrame([(r[2] or "und", r[1]) for r in rows], "lang string, text string").repartition(7)
    got = collocations.frequent_phrases(spark, df, 5, 6)
    phrases = {(r.lang, r.phrase): r.f for r in got.collect() if " " in r.phrase}
    assert len(phrases) > 30 and asked[0].count() == len(phrases)
    for lang, _, phrase, a, *_ in _phrases(rows, 6, 100, 2000):
        assert phrases[lang, phrase] == a


def test_words_of_one_code_are_told_apart(spark, monkeypatch):
    """Four codes for all words: frequent ones get codes of their own, others none."""
    monkeypatch.setattr(collocations, "_code", lambda h: (h >> np.uint64(62)) + np.uint64(1 << 24))
    for bits in (27, 8):
        got = collocations.collocations(spark, spark.createDataFrame(_phrase_rows(), DDL).repartition(3), min_count=6, bits=bits)
        assert {tuple(r) for r in got.collect()} == _phrases(_phrase_rows(), 6, 100, 2000)


@pytest.mark.parametrize("order", [2, 3, 5])
def test_merged_windows_count_each_window(order):
    rng = np.random.default_rng(order)
    parts = [rng.integers(1, 5, rng.integers(order, 300)).astype(np.uint32) for _ in range(30)]
    want = Counter(tuple(p[i:i + order].tolist()) for p in parts for i in range(len(p) - order + 1))
    for limit in (1 << 22, 100):
        got = Counter()
        for columns, counts in collocations.merged_windows(
                (collocations.packed(p, np.arange(len(p) - order + 1), order) for p in parts), limit):
            codes = np.stack([x for c in columns for x in (c >> np.uint64(32), c & np.uint64(0xFFFFFFFF))], 1)[:, :order]
            for w, n in zip(codes.tolist(), counts.tolist()):
                got[tuple(w)] += n
        assert got == want
    everything = [None, None] + [np.full(1 << 10, (1 << 64) - 1, np.uint64)] * order
    at, keys = collocations.windows(parts[0], order, 0, everything)
    assert (collocations.packed_keys(collocations.packed(parts[0], at, order), order) == keys).all() and len(at)
