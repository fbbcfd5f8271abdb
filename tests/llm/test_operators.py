"""The ten operators against brute force on small tables with nulls, empty and long texts,
repeated rows, copies, ties and extra columns whose names clash."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import (best_fit, cube_mixing, hnsw_dedup, jaccard_tiles, kd_shards, pii_surrogates,
                            quality_divergence, secret_scan, suffix_dedup, toxicity_kn)
from panelforge.llm.components import connected_components
from panelforge.llm.queries import vocabulary

DDL = "doc_id long, text string, lang string, source string, n_chars long, Text int, size string, tie int, h int"


def _texts():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, long_one = prose(80), prose(6000)
    near = prose(120).split()
    out = [None, "", "one", "two words", "\n\n \t", long_one, passage + " " + prose(60), prose(30) + " " + passage, passage]
    out += [" ".join(near[:i] + ["changed"] + near[i + 1:]) for i in (0, 3, 60, 119)] + [" ".join(near).upper()] * 2
    out += [prose(rng.randint(1, 200)) for _ in range(25)] + ["spam line\n" * 60] * 3
    return out


@pytest.fixture(scope="module")
def docs(spark):
    texts = _texts()
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or ""), i, "x", 1, 2)
            for i, t in enumerate(texts)]
    rows += [rows[6], rows[0]]  # repeated rows
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def _unique(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    edges += [(None, 1), (5, 5)]
    got = {r.id: r.component for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ 1
def test_hnsw(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 16))
    near = base[:40] + rng.normal(size=(40, 16)) * 0.05
    x = [v.tolist() for v in np.concatenate([base, near, base[:5], np.repeat(base[7:8] * 2, 30, 0)])]
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows = [(i, v, 0) for i, v in enumerate(x + bad)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw_dedup.near_duplicates(
        spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep int"), chunk_rows=100).collect()}
    u = np.array(x)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    comp = list(range(len(u)))
    for _ in range(5):
        comp = [min([comp[i]] + [comp[j] for j in np.flatnonzero(links[i])]) for i in range(len(u))]
    assert got == {i: (int(links[i].sum()), comp[i], comp[i] == i) for i in range(len(u))} | {
        i: (0, i, True) for i in range(len(u), len(rows))}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hnsw_dedup.near_duplicates(spark, none).count() == 0


def test_beams_widen_until_the_audit_passes():
    x = np.random.default_rng(3).normal(size=(900, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g, order = hnsw_dedup.build(x)
    assert np.allclose(g.x, x[order])
    r, c = hnsw_dedup.linked(hnsw_dedup.Graph.load(g.dump()), g.x, 0.8, beam=2)
    assert len(r) >= 0.99 * (g.x @ g.x.T >= 0.8 - 1e-4).sum()


class _Blind:
    """Exact answers, but narrow beams don't see the second points of small groups."""

    def __init__(self, x, hidden, least):
        self.x, self.hidden, self.least = x, hidden, least

    def query(self, q, width):
        sims = q @ self.x.T
        if width < self.least:
            sims[:, self.hidden] = -1
        ids = np.argsort(-sims, axis=1, kind="stable")[:, :width]
        return ids, np.take_along_axis(sims, ids, 1)


def _hot_and_pairs():
    rng = np.random.default_rng(5)
    hot = rng.normal(size=(1, 24)) + rng.normal(size=(400, 24)) * 0.02
    first = rng.normal(size=(300, 24))
    x = np.concatenate([hot, first, first + rng.normal(size=first.shape) * 0.02])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_audit_sees_lost_links_of_small_groups_beside_a_hot_one():
    x = _hot_and_pairs()
    x32, all_ = x.astype(np.float32), (x @ x.T >= 0.9)
    r, c = hnsw_dedup.linked(_Blind(x32, np.arange(700, 1000), 256), x32, 0.9, own=np.arange(len(x)))
    assert set(zip(r.tolist(), c.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(all_))))


def test_links_found_in_one_direction_count_for_both(monkeypatch):
    x = _hot_and_pairs()
    a, b = x[::2], x[1::2]
    one_way = lambda graph, q, *args, own=None: (
        np.nonzero(q @ graph.x.T >= 0.9) if graph.x.shape == a.shape and graph.x[0, 0] == np.float32(a[0, 0])
        else (np.zeros(0, int), np.zeros(0, int)))
    monkeypatch.setattr(hnsw_dedup, "linked", one_way)
    g, h = _Blind(a.astype(np.float32), [], 0), _Blind(b.astype(np.float32), [], 0)
    for f, y, k, z in ((g, a, h, b), (h, b, g, a)):
        assert (hnsw_dedup.between(f, y, k, z, 0.9, 100) == (y @ z.T >= 0.9)).all()
    assert (hnsw_dedup.between(g, a, g, a, 0.9, 100) == np.triu(a @ a.T >= 0.9, 1)).all()


# ------------------------------------------------------------------ 2
def test_token_ids_equal_tokenizers():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary())
    texts = ["", " a  b\n\n c\t", "it's 1,234.5 €uro ñandú 日本語 🙂", "x" * 500, "<|endoftext|> end", "a \n<|endoftext|><|endoftext|>b",
             "<|endoftext| <|end"] + [x or "" for x in _texts()]
    assert [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] == [
        best_fit.token_ids(best_fit.encoder(vocabulary()), x) for x in texts]


def _best_fit_decreasing(lengths, capacity):
    rest = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rest) if r >= n]
        if fits:
            i = min(fits, key=lambda i: rest[i])
            rest[i] -= n
        else:
            rest.append(capacity - n)
    return rest


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 3, rng.randint(1, 40), 40, 17]) for _ in range(rng.randint(1, 400))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    room = {}
    for length, first, start, each, offset in (slots := best_fit.plan(histogram, 40)):
        later = [s[1] for s in slots if s[0] == length and s[1] > first]
        for k in range(min(later, default=histogram[length]) - first):
            room.setdefault(start + k // each, []).append((offset + k % each * length, length))
    for places in room.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 40
    assert sorted(40 - sum(n for _, n in p) for p in room.values()) == sorted(_best_fit_decreasing(lengths, 40))


def test_pack(spark, docs, empty):
    pieces, placed = best_fit.pack(spark, docs, vocabulary())
    enc = best_fit.encoder(vocabulary())
    rows = placed.collect()
    by_doc = {}
    for r in pieces.collect():
        by_doc.setdefault(r.doc_id, set()).add((r.piece, r.start, r.length, bytes(r.ids)))
    for i, t in enumerate(_texts()):
        ids = enc.encode_ordinary(t or "") + [0]
        raw = b"".join(x[3] for x in sorted(by_doc[i]))
        assert raw == np.array(ids, "<u4").tobytes()
        assert all(x[2] == 2048 for x in sorted(by_doc[i])[1:]) and len(by_doc[i]) == -(-len(ids) // 2048)
    crc = {(i, x[0]): zlib.crc32(x[3]) for i, s in by_doc.items() for x in s}
    assert all(crc[r.doc_id, r.piece] == r.ids_crc32 for r in rows) and len(rows) == pieces.count()
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        ends = [0] + [a + n for a, n in sorted(s)]
        assert [a for a, _ in sorted(s)] == ends[:-1] and ends[-1] <= 2048
    assert len(seqs) == len(_best_fit_decreasing([r.length for r in rows], 2048))
    assert best_fit.pack(spark, empty, vocabulary())[1].count() == 0


# ------------------------------------------------------------------ 3
SECRETS = ["password = abc123def", "x SECRET:\"Zz9+/_.=-\" token=short1 token:abc", "AKIA" + "Q7" * 9 + " AKIASHORT",
           "deadbeef" * 3 + " " + "a1" * 11, "api_key='k1' apikey: longenough9 secret=token:abcdef", None, "", "héé token=ünder1234",
           "db://user:Pa55w0rdX@host Kelvin toKen=abcdefgh"]


def test_secrets(spark, empty):
    import re
    rows = [(i, t, f"s{i}", i) for i, t in enumerate(SECRETS)] + [(100 + i, "token=widely1copied9 %d" % i, f"s{i}", 0)
                                                                  for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row int")
    got = _unique(secret_scan.scan(spark, df))
    for i, t, *_ in rows:
        t, exp = t or "", []
        for kind, rx, least in (("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
                                ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
            for m in re.finditer(rx, t):
                if len(m[2] if kind == "assign" else m[0]) >= least:
                    exp.append((kind, m.start(), m.end()))
        assert sorted((s.kind, s.start, s.stop) for s in got[i].base) == sorted(exp)
        text = ",".join(f"{s.kind}:{s.start}:{s.stop}" for s in got[i].base)
        assert hashlib.sha256(text.encode()).hexdigest() == secret_scan.digest(exp)
    assert [s.kind for s in got[8].spans] == ["live"]             # the URL's password is added
    assert got[100].base[0].n_owners == 8 and not got[100].base[0].live  # widely copied
    masked = _unique(secret_scan.mask(spark, df.withColumn("n_chars", F.length("text").cast("long"))))
    assert "Pa55w0rdX" not in masked[8].text and masked[100].text == "token=widely1copied9 0"
    assert masked[5].text is None and masked[6].text == "" and masked[8].n_chars == len(masked[8].text)
    assert secret_scan.scan(spark, empty).count() == 0


def test_url_passwords_of_any_length():
    rng = random.Random(3)
    word = "".join(rng.choice("abcdefghijABCDEFGHIJ0123456789") for _ in range(400))
    for user, password in (("u" * 90, word[:135]), ("me", word), ("me", word[:6])):
        assert password in [m[1] for m in secret_scan.URL_PASSWORD.finditer(f"see ftp://{user}:{password}@host/x and ://")]


def test_ownership_alone_decides_on_base_spans(spark):
    letters = "AKIA" + "QWERTYUIOPASDFGH"
    rows = [(1, f"id {letters} end", "a"), (2, "password = correcthorsebattery", "a"), (3, "x " + "7" * 30 + " y", "b"),
            (4, "see " + "z" * 30 + "1Z", "b")]
    rows += [(10 + i, f"token=placeholder {i}", f"s{i}") for i in range(8)]
    rows += [(20 + i, f"token=onlytwoowners {i}", f"s{i % 2}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {i: r.text for i, r in _unique(secret_scan.mask(spark, docs)).items()}
    assert got[1] == "id <secret> end" and got[2] == "<secret>" and got[3] == "x <secret> y"
    assert got[4] == rows[3][1]                                    # an added candidate must look random
    assert all(got[10 + i] == f"token=placeholder {i}" and got[20 + i] == f"<secret> {i}" for i in range(8))


# ------------------------------------------------------------------ 4
def test_surrogates(spark, empty):
    t = "Mail A@b.com, a@B.COM; Mrs. Anna Smith and Mr Smith, +1 (499) 555-6503 and +14995556503, 10.0.0.1, 4041894974608795."
    rows = [(1, t, 0), (1, t, 0), (2, "again a@b.com 10.0.0.2", 0), (3, None, 0), (4, "", 0), (5, "clean 4.0. text", 0)]
    rows += [(10 + i, f"ip 1.1.1.{i}", 0) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind int")
    out = pii_surrogates.replace_pii(spark, df, "k")
    got = _unique(out)
    one = got[1].text
    for leaked in ("A@b.com", "a@B.COM", "Smith", "555-6503", "10.0.0.1", "4041894974608795"):
        assert leaked not in one
    import re
    mails = [m.lower() for m in re.findall(r"\S+@\w+\.\w+", one)]
    assert mails[0] == mails[1] and mails[0] in got[2].text       # one person, one surrogate
    phones = re.findall(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", one)[0]
    assert "+1" + "".join(phones) in one                          # the same number in two layouts
    assert re.search(r"Mrs\. [A-Z][a-z]+ [A-Z][a-z]+ and Mr [A-Z][a-z]+", one)
    octets = [got[10 + i].text for i in range(9)]
    assert len(set(octets)) == 9 and all(re.fullmatch(r"ip \d\.\d\.\d\.\d", x) for x in octets)
    assert got[3].text is None and got[4].text == "" and got[5].text == "clean 4.0. text" and out.count() == len(rows)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, pii_surrogates.replace_pii(spark, df, "k").collect()), key=str)
    assert pii_surrogates.replace_pii(spark, empty, "k").count() == 0


def test_whole_names_and_their_untitled_mentions(spark):
    t = ("Mr McDonald met Mr McCarthy, Mrs Anna Maria Schmidt, Mrs Müller-Lange, Mr O'Neill's dog, Mr J. Smith and Dr Smith. "
         "Later Anna Smith, SMITH, Smithers and Schmidt left; Müller, McDonald's and O’Neill stayed. Herr van der Berg I saw.")
    rows = [(1, t), (2, "Smith, the smith"), (3, "Prof. Smith; Mr John Smith. John"), (4, "Mr J. 5")]
    got = {i: r.text for i, r in _unique(pii_surrogates.replace_pii(spark, spark.createDataFrame(
        rows, "doc_id long, text string"), "k")).items()}
    one = got[1]
    for leaked in ("Donald", "Carthy", "Anna", "Maria", "Schmidt", "Lange", "Müller", "Neill", "J.", "Smith,", "SMITH", "Berg"):
        assert leaked not in one, leaked
    assert "Smithers" in one and "van der " in one and " I saw." in one and "dog" in one
    import re
    w = r"([A-Z][a-z]+)"
    m = re.fullmatch(rf"Mr {w} met Mr {w}, Mrs {w} {w} {w}, Mrs {w}-{w}, Mr {w}'s dog, Mr ([A-Z])\. {w} and Dr {w}\. "
                     rf"Later {w} {w}, ([A-Z]+), Smithers and {w} left; {w}, {w}'s and {w} stayed\. Herr van der {w} I saw\.", one)
    assert m, one
    g = m.groups()
    assert g[9] == g[10] == g[12] == g[13].capitalize() and g[11] == g[2] and g[14] == g[4] and g[15] == g[5]
    assert g[16] == g[0] != g[1] and g[17] == g[7]
    assert got[2] == rows[1][1]                                   # no titled name in this document
    x = re.fullmatch(rf"Prof\. {w}; Mr {w} {w}\. {w}", got[3]).groups()
    assert x[0] == x[2] == g[9] and x[1] == x[3] != "John"
    assert re.fullmatch(r"Mr [A-Z]\. 5", got[4]) and got[4] != "Mr J. 5"


def _luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in twice) % 10 == 0


def _iban(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def test_check_digits_and_long_addresses(spark):
    """Valid numbers stay valid, other long numbers stay, addresses of any length are replaced
    whole, nulls and ties and very long texts come through; distinct and coreferent."""
    rng = random.Random(4)
    cards = [d for d in ("4" + "".join(rng.choice("0123456789") for _ in range(rng.randint(12, 18))) for _ in range(900))
             if _luhn(d)]
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR14 2004 1010 0505 0001 3M02 606"]
    long_mail, dots = "x" * 70 + "@" + "y" * 70 + ".org", "joe@a.b.c.d.e.f.g.h.i.jkl.mno"
    assert len(cards) > 50 and all(map(_iban, ibans)) and not _luhn("1234567890123")
    rows = [(i, f"pay {c} or {c[:4]} {c[4:]} now", "x") for i, c in enumerate(cards)]
    rows += [(1000 + i, f"to {x}, {x.replace(' ', '')}.", "x") for i, x in enumerate(ibans)]
    rows += [(2000, "order 1234567890123 and 1234-5678-90123 left", "x"), (2001, f"<{long_mail}> <{dots}>", "x"),
             (2002, "DE00 3704 0044 0532 0130 00", "x"), (None, f"pay {cards[0]}", "x"), (2003, "w " * 300_000 + cards[0], "x"),
             (2004, "j@" + "a." * 30_000 + "com", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, TEXT string")
    out = pii_surrogates.replace_pii(spark, df, "k").collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    new = []
    for i, c in enumerate(cards):
        a, b = got[i].text[4:-4].split(" or ")
        assert a == b.replace(" ", "") and len(a) == len(c) and a[0] == "4" and a != c and _luhn(a), (c, a, b)
        new.append(a)
    assert len(set(new)) == len(set(cards))
    for i, x in enumerate(ibans):
        a, b = got[1000 + i].text[3:-1].split(", ")
        assert a.replace(" ", "") == b and _iban(a) and a[:2] == x[:2] and a != x
        assert [c == " " for c in a] == [c == " " for c in x] and [c.isdigit() for c in a] == [c.isdigit() for c in x]
    assert got[2000].text.startswith("order 1234567890123 and ") and "1234-5678-90123" not in got[2000].text
    assert (got[2000].n_card, got[2000].n_entities) == (1, 1)
    for part in ("xxx", "yyy", "jkl", "joe"):
        assert part not in got[2001].text
    assert got[2001].text.endswith(".mno>") and got[2001].n_email == 2
    assert got[2002].text[:2] == "DE" and got[2002].text != rows[-4][1]
    assert got[None].text == f"pay {new[0]}" and got[2003].text == "w " * 300_000 + new[0]
    assert got[2004].n_email == 1 and "a.a." not in got[2004].text


def test_full_format_classes_come_to_an_end(spark):
    mails = [(c, f"{c}@b.co") for c in "abcdefghijklmnopqrstuvwxyz"] + [(c, f"{c}@d.co") for c in "abcdefghijklmnopqrstuvwxyz"]
    phones = [f"+1{i:04d}" for i in range(0, 10000, 7)]
    ips = [f"{a}.{b}.{c}.{d}" for a in range(10) for b in range(10) for c in range(10) for d in range(10)]
    rows = [("email", m) for _, m in mails] + [("phone", p[1:]) for p in phones] + [("ip", x) for x in ips]
    rows += [("phone", f"2{i:02d}") for i in range(100)]          # a full class
    df = spark.createDataFrame([(k, c, None) for k, c in rows], "kind string, canon string, style string")
    got = pii_surrogates.dictionary(spark, df, "k").collect()
    assert len(got) == len(rows) and {(r.kind, r.canon) for r in got} == set(rows)
    assert len({(r.kind, r.new) for r in got}) == len(rows) and not {(r.kind, r.new) for r in got} & set(rows)
    to = {r.canon: r.new.split("@")[1] for r in got if r.kind == "email"}
    assert len({v for k, v in to.items() if k.endswith("@b.co")}) == 1 and len(set(to.values())) == 2


# ------------------------------------------------------------------ 5
def test_kd_shards(spark, docs, empty):
    out = kd_shards.kd_shards(spark, docs, shards=5).collect()
    texts = _texts()
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 8 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
               for r in out) and len(out) == docs.count()
    total, biggest = sum(r.size for r in out), max(r.size for r in out)
    for s in range(5):
        mine = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 5) <= 2 * biggest
    same = spark.createDataFrame([(i, "equal text", "en", "s") for i in range(240)], "doc_id long, text string, lang string, source string")
    counts = {r.shard: r["count"] for r in kd_shards.kd_shards(spark, same, shards=24).groupBy("shard").count().collect()}
    assert counts == {s: 10 for s in range(24)}
    assert kd_shards.kd_shards(spark, empty, shards=24).count() == 0


# ------------------------------------------------------------------ 6
def test_quality(spark, docs, empty):
    ws = " \t\n\r\x0b\x0c"
    out = _unique(quality_divergence.judge(spark, docs))
    for i, t in enumerate(_texts()):
        t = t or ""
        words = [w for w in "".join(" " if c in ws else c for c in t).split(" ") if w]
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        again = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)} if len(words) < 3000 else set()
        lines, dup, seen = [x for x in t.split("\n") if x.strip(ws)], 0, set()
        for x in lines:
            dup += x in seen
            seen.add(x)
        r = out[i]
        if len(words) < 3000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
                len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(again))
            assert r.base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality_divergence.judge(spark, empty).count() == 0


def test_an_empty_language_is_none(spark):
    """All documents make the reference of '' whether the language is null or empty."""
    rows = [(i, f"word{i % 7} common text, number {i}.") for i in range(40)]
    got = []
    for lang in (None, ""):
        d = spark.createDataFrame([(*r, "en" if r[0] % 2 else lang) for r in rows], "doc_id long, text string, lang string")
        refs = quality_divergence.references(d)
        assert set(refs) == {"", "en"}
        got.append([(r[0], r[1].tolist(), r[2].tolist()) for _, r in sorted(refs.items())])
    assert got[0] == got[1]


def test_js_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0, 2.0, 2])
    m = (p / 4 + q / 4) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
    assert abs(quality_divergence.js_distance(p, q) - np.sqrt((kl(p / 4) + kl(q / 4)) / 2)) < 1e-12
    assert quality_divergence.js_distance(p, p) == 0 and quality_divergence.js_distance(p * 0, q) == 0


# ------------------------------------------------------------------ 7
def test_toxicity_held_out(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        t = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), rng.choice(["vilea", "vileb", "vilec"]))
        rows.append((i, " ".join(t), i))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, None, 0), (1001, "", 0), (1001, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    fitted = toxicity_kn.fit(spark, df, lab, learn_from=~toxicity_kn.held_out(F.col("doc_id")))
    got = toxicity_kn.score_columns(spark, df, fitted).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    none = toxicity_kn.fit(spark, df, lab.where("toxic = 0"))
    assert {r.score for r in toxicity_kn.score_columns(spark, df, none).collect()} == {0.0}
    assert toxicity_kn.score_columns(spark, df.limit(0), fitted).count() == 0


# ------------------------------------------------------------------ 8
def test_targets():
    sizes = {"b": 100, "a": 10, None: 50, "c": 0}
    got = cube_mixing.targets(sizes)
    assert got["a"] == 20 and got["c"] == 0 and abs(sum(got.values()) - 240) < 1e-9
    assert all(got[s] <= 2 * n + 1e-9 for s, n in sizes.items())


@pytest.mark.parametrize("seed", range(4))
def test_flight_keeps_both_sums(seed):
    rng = np.random.default_rng(seed)
    p, s = np.full(200, 0.3), rng.integers(0, 500, 200)
    out = cube_mixing.flight(p, s, np.random.default_rng(seed))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - 60) < 1e-6 and abs(out @ s - p @ s) < 1e-4


def test_mix(spark, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 90)) if i % 50 else None, ["a", "b", None, "c"][min(i % 9, 3)], i)
            for i in range(3000)]
    rows += [rows[10], rows[10]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(5)
    out = cube_mixing.mix(spark, df, chunk_rows=100)
    got = out.collect()
    assert len(got) == len(rows) and out.columns == [*df.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies"]
    for s in ("a", "b", "c", None):
        mine = [r for r in got if r.source == s]
        assert {r.mix_source_size for r in mine} == {sum(r.mix_size for r in mine)}
        assert abs(sum(r.mix_size * r.mix_copies for r in mine) - mine[0].mix_target) <= 3
    assert all(0 <= r.mix_copies <= 2 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, cube_mixing.mix(spark, df.repartition(7), chunk_rows=100).collect()))
    assert cube_mixing.mix(spark, empty).count() == 0


# ------------------------------------------------------------------ 9
@pytest.mark.parametrize("pairwise", [256, 2])
def test_suffix(spark, docs, empty, pairwise):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = {}
    for _, b in rows:
        for j in range(len(b) - 199):
            seen[b[j:j + 200]] = seen.get(b[j:j + 200], 0) + 1
    exp = []
    for i, b in rows:
        cover = bytearray(len(b))
        for j in range(len(b) - 199):
            if seen[b[j:j + 200]] > 1:
                cover[j:j + 200] = b"\1" * 200
        kept = bytes(x for x, c in zip(b, cover) if not c)
        exp.append((i, len(b), sum(cover), hashlib.sha256(kept).hexdigest()))
    out = suffix_dedup.remove_repeats(spark, docs, pairwise=pairwise).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), r.kept_sha256) for r in out) == sorted(exp)
    if pairwise == 2:
        assert suffix_dedup.remove_repeats(spark, empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_few_texts_share_the_stretches_of_many(monkeypatch, seed):
    rng = random.Random(seed)
    gram = bytes(rng.choices(b"abcdef", k=100))
    sides = [[bytes(rng.choices(b"xyz", k=120)) for _ in range(2)] for _ in range(2)]
    texts, offsets = [], []
    for _ in range(6):
        left, right = (rng.choice(s)[:rng.randint(40, 120)] for s in sides)
        texts.append(left[::-1] + gram + right)
        offsets.append(len(left))
    assert len(texts) <= suffix_dedup.FEW
    few = suffix_dedup.stretches(texts, offsets)
    monkeypatch.setattr(suffix_dedup, "FEW", 0)
    assert few == suffix_dedup.stretches(texts, offsets) and any(few)


def test_units_of_a_gram_make_no_call_of_their_own(spark, monkeypatch):
    """Two hundred passages, each in two texts with other words around it: Python gets the units in
    batches, not gram by gram; the passages go, the words around them stay."""
    rng = random.Random(9)
    word = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    passages = [word(230) for _ in range(200)]
    rows = [(i, f"{word(150)}#{passages[i % 200]}#{word(150)}") for i in range(400)]
    plans, plain = {}, suffix_dedup.materialize

    def seen(spark, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(spark, df, name)

    monkeypatch.setattr(suffix_dedup, "materialize", seen)
    out = suffix_dedup.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert "FlatMapGroupsInArrow" in plans["suffix-units"] and "FlatMapGroupsInArrow" not in plans["suffix-near"]
    assert len(out) == 400 and all(
        sum(s.stop - s.start for s in r.spans) >= 230 and r.n_bytes == 532 and len(r.kept) <= 302 for r in out)


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(3)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 40))}) for _ in range(7)]
    packed = [suffix_dedup.front_code([(s, 1 << 63, 5, False) for s in r]) for r in runs]
    got = [(s, twice) for s, _, _, twice in suffix_dedup.merged(packed)]
    every = [s for r in runs for s in r]
    assert got == [(s, every.count(s) > 1) for s in sorted(set(every))]
    assert list(suffix_dedup.merged([])) == []


# ------------------------------------------------------------------ 10
def test_jaccard(spark, docs, empty):
    sets, ids = {}, {}
    for i, t in enumerate(_texts()):
        w = [x for x in (t or "").encode().lower().split()]
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    for _ in range(6):
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    got = jaccard_tiles.jaccard_classes(spark, docs)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == {(i, len(s), comp[i]) for i, s in sets.items()}
    assert len({c for c in comp.values()}) < len(comp) - 3 and got.count() == docs.count()
    assert jaccard_tiles.jaccard_classes(spark, empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_tile(seed):
    rng = np.random.default_rng(seed)
    for n in (9, 10, 11, 18, 19, 40, 100, 333, 1000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for drop in range(n // 9 + 1):
            for add in range(n // 9 + 1 - drop):
                b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
                if 10 * (n - drop) >= 9 * (n + add):
                    assert set(jaccard_tiles.signatures(np.unique(a))) & set(jaccard_tiles.signatures(np.unique(b)))


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_tile_at_other_thresholds(seed):
    rng = np.random.default_rng(seed)
    for p, q in ((8, 10), (1, 2), (19, 20)):
        for n in (4, 5, 6, 9, 19, 40, 100, 333):
            a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            mine = set(jaccard_tiles.signatures(np.unique(a), (p, q)))
            for drop in range(n * (q - p) // p + 1):
                for add in range(0, n * (q - p) // p + 1 - drop, 1 + n // 40):
                    b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
                    if len(b) and q * (n - drop) >= p * (n + add) and drop + add:
                        assert mine & set(jaccard_tiles.signatures(np.unique(b), (p, q)))


def test_one_doc_id_with_several_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    one, other, third = ([word() for _ in range(60)] for _ in range(3))
    near = lambda w: " ".join(w[:-1] + ["end"])
    rows = [(1, " ".join(one)), (1, " ".join(other)), (5, near(one)), (6, near(other)), (7, " ".join(third)), (8, near(third)),
            (8, near(other) + " x"), (9, near(third) + " y"), (9, ""), (10, ""), (11, " ".join(word() for _ in range(60)))]
    got = jaccard_tiles.jaccard_classes(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(
        (i, max(0, len(t.split()) - 2), 1 if i < 10 else i) for i, t in rows)


def test_corpus_back_off(spark):
    texts = ["a b a", "b c", "A", "", None, "c c c", "a d"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.w: r.n for r in toxicity_kn.document_counts(df).collect()}
    (_, w), _ = toxicity_kn._Words().ids([b"a b c d"])
    assert [got[i] for i in w.view(np.int64).tolist()] == [3, 2, 2, 1] and len(got) == 4
    assert toxicity_kn.document_counts(df.limit(0)).count() == 0
    # a word seen alike in both classes: the more documents of the corpus hold it, the nearer
    # its ratio is to that of a word never seen
    labelled = spark.createDataFrame([("x y x z q", 1), ("y x w", 1), ("m n m o q", 0), ("n m n p", 0), ("o m", 0)],
                                     "text string, toxic long")
    counts = toxicity_kn.bigram_counts(labelled)
    (_, q), _ = toxicity_kn._Words().ids([b"z"])
    ratio = []
    for extra in (0, 400):
        corpus = labelled.select("text").union(spark.createDataFrame([("z",)] * extra, "text string"))
        model = toxicity_kn.kneser_ney(spark, counts, toxicity_kn.document_counts(corpus))
        ratio.append(abs(model["word_r"][np.searchsorted(model["word"], q[0])] - model["new"][0]))
        assert np.isfinite(model["word_r"]).all() and np.isfinite(model["pair_r"]).all()
    assert ratio[1] < ratio[0]


def test_open_pairs_are_those_within_the_bound(spark, monkeypatch):
    """Blocks of few members; a tile of one component, tiles of many, batches that end in a group."""
    rng = random.Random(21)
    rows = []
    for tile, size in ((1, 2), (2, 40), (3, 7), (4, 25)):
        base = [rng.getrandbits(63) for _ in range(jaccard_tiles.WORDS)]
        for _ in range(size):
            bits = [b ^ (1 << rng.randrange(63)) if rng.random() < 0.5 else b for b in base]
            if rng.random() < 0.3:
                bits = [rng.getrandbits(63) for _ in base]
            rows.append((tile, len(rows), 7 if tile == 4 else rng.randrange(6), rng.randint(180, 260), *bits))
    names = [f"m{i}" for i in range(jaccard_tiles.WORDS)]
    df = spark.createDataFrame(rows, "tile long, rep long, component long, n long, " + ", ".join(f"{m} long" for m in names))
    monkeypatch.setattr(jaccard_tiles, "BLOCK", 6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        got = sorted(map(tuple, jaccard_tiles.open_pairs(df, (8, 10)).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[1] < y[1] and x[2] != y[2] and min(x[3], y[3]) * 10 >= max(x[3], y[3]) * 8:
                apart = sum(bin(a ^ b).count("1") for a, b in zip(x[4:], y[4:]))
                if (x[3] + y[3] - apart) * 18 >= (x[3] + y[3]) * 16:
                    want.append((x[1], y[1]))
    assert got == sorted(want) and 20 < len(want) < 600


def test_pairs_of_near_copies_come_once_and_grow_with_the_group(spark, monkeypatch):
    """One group in which a third of all pairs are links: no pair of two components for each."""
    def rows_made(size):
        rng = random.Random(23)
        base = ["w%d" % rng.randrange(5000) for _ in range(150)]
        texts = []
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice((2, 2, 3))):
                words[rng.randrange(len(words))] = "v%d" % rng.randrange(10 ** 6)
            texts.append(" ".join(words))
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        made, first = [], jaccard_tiles.open_pairs
        with monkeypatch.context() as m:
            m.setattr(jaccard_tiles, "open_pairs", lambda *a: made.append(first(*a)) or made[-1])
            got = {r.doc_id: r.component_id for r in jaccard_tiles.jaccard_classes(spark, df).collect()}
        sets = [{tuple(t.split()[i:i + 3]) for i in range(148)} for t in texts]
        root = list(range(size))
        for i in range(size):
            for j in range(i):
                x, y = sets[i], sets[j]
                if 100 * len(x & y) >= 90 * len(x | y) and root[i] != root[j]:
                    old, new = max(root[i], root[j]), min(root[i], root[j])
                    root = [new if r == old else r for r in root]
        assert got == dict(enumerate(root))
        return sum(d.count() for d in made)

    assert rows_made(160) < 20 * 160     # 12,720 pairs, each in several tiles


def test_documents_that_share_a_passage_make_no_pairs(spark, monkeypatch):
    """The rows that round 2 makes don't grow with the square of the documents of a passage."""
    rng = random.Random(22)
    words = ["w%d" % i for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    seen = []
    first = jaccard_tiles.open_pairs
    monkeypatch.setattr(jaccard_tiles, "open_pairs", lambda *a: seen.append(first(*a)) or seen[-1])
    texts = [passage + " " + " ".join(rng.choice(words) for _ in range(60)) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = jaccard_tiles.jaccard_classes(spark, df, shingle=5, threshold=(8, 10)).collect()
    assert all(r.doc_id == r.component_id for r in out) and seen[0].count() <= 120


def test_wide_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(4)
    for n, m, shared in [(257, 300, 200), (1000, 1030, 1000), (1024, 1025, 3), (5000, 4200, 4100), (300, 300, 300)]:
        pool = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.r_[pool[:shared], pool[n:n + m - shared]])
        x, y = jaccard_tiles.wide_bitmap(a), jaccard_tiles.wide_bitmap(b)
        apart = jaccard_tiles.bits_apart(x, y)
        assert apart == jaccard_tiles.bits_apart(y, x) <= len(np.setxor1d(a, b))
        assert shared <= n // 2 or apart >= 0.4 * len(np.setxor1d(a, b))  # close enough to rule pairs out
    assert jaccard_tiles.wide_bitmap(pool[:256]) is None


def test_long_texts_read_only_where_the_wide_bound_allows(spark, monkeypatch):
    """Long documents that share half of their words by passages, and near copies of some: brute
    force finds the same classes, and only few pairs come to the exact join."""
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(10 ** 6)
    passages = [[word() for _ in range(700)] for _ in range(3)]
    texts = [passages[i % 3] + [word() for _ in range(rng.randrange(600, 800))] for i in range(30)]
    for i in range(6):
        copy = list(texts[i])
        for at in rng.sample(range(len(copy)), 8 + 10 * i):
            copy[at] = word()
        texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100, None), (101, "")]
    asked, first = [], jaccard_tiles.screened
    monkeypatch.setattr(jaccard_tiles, "screened", lambda pairs, *a: asked.append((pairs, first(pairs, *a))) or asked[-1][1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_tiles.jaccard_classes(spark, df, shingle=5, threshold=(8, 10)).collect()}
    sets = [{tuple(t[k:k + 5]) for k in range(len(t) - 4)} for t in texts]
    exp = {i: i for i in (*range(len(texts)), 100, 101)}
    for i in range(len(sets)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                old, new = max(exp[i], exp[j]), min(exp[i], exp[j])
                exp = {k: new if v == old else v for k, v in exp.items()}
    assert got == exp and 0 < sum(exp[30 + i] == i for i in range(6)) < 6
    assert sum(out.distinct().count() for _, out in asked) <= 20 < sum(pairs.count() for pairs, _ in asked)


def test_near_copies_that_hardly_miss_a_link_make_no_pairs(spark, monkeypatch):
    """A group whose pairs all have a Jaccard of 0.86: bits of shared elements hide no difference."""
    rng = random.Random(31)
    base = ["w%d" % i for i in range(250)]
    texts = []
    for i in range(60):
        words = list(base)
        for k in range(3):
            words[80 * k + rng.randrange(3, 77)] = f"v{i}_{k}"
        texts.append(" ".join(words))
    seen, first = [], jaccard_tiles.open_pairs
    monkeypatch.setattr(jaccard_tiles, "open_pairs", lambda *a: seen.append(first(*a)) or seen[-1])
    out = jaccard_tiles.jaccard_classes(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    sets = [{tuple(t.split()[i:i + 3]) for i in range(248)} for t in texts]
    linked = {(i, j) for i in range(60) for j in range(i) if 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j])}
    names = {r.doc_id: r.component_id for r in out.collect()}
    assert all(names[i] == names[j] for i, j in linked) and len(set(names.values())) > 40
    assert seen[-1].distinct().count() < 90      # of 1,770 pairs


def test_a_member_is_compared_with_few_whatever_tiles_it_shares(spark, monkeypatch):
    """Near copies that all link, but not with their leader: the pairs to verify are a few a member."""
    rng = random.Random(37)
    base = ["w%d" % i for i in range(150)]
    texts = []
    for i in range(160):
        words = list(base)
        for k in ([12, 50, 90, 130] if i == 0 else [rng.randrange(5, 145)]):
            words[k] = f"v{i}_{k}"
        texts.append(" ".join(words))
    asked, first = [], jaccard_tiles.screened
    monkeypatch.setattr(jaccard_tiles, "screened", lambda pairs, *a: asked.append(pairs) or first(pairs, *a))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_tiles.jaccard_classes(spark, df, shingle=5, threshold=(8, 10)).collect()}
    sets = [{tuple(t.split()[i:i + 5]) for i in range(146)} for t in texts]
    linked = {(i, j) for i in range(160) for j in range(i) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    assert len(linked) > 12_000 and all(got[i] == got[j] for i, j in linked) and sum(i == 0 or j == 0 for i, j in linked) < 20
    assert sum(pairs.count() for pairs in asked) <= (1 + jaccard_tiles.NEAREST + jaccard_tiles.DRAWN) * 160


def test_sparse_bitmaps_are_folded(spark):
    from panelforge.llm.common import bitmap_of, in_bitmap
    values = np.random.default_rng(3).integers(-1 << 63, 1 << 63, 3000)
    held = bitmap_of(spark.createDataFrame([(int(v),) for v in values], "h long"), "h")
    assert 1 << 10 <= len(held) <= 512 * 3000 // 64 and in_bitmap(held, values.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 1 << 63, 100_000, np.uint64)
    assert in_bitmap(held, others).mean() < 0.01


def test_bitmaps_see_the_differences_of_long_sets():
    rng = np.random.default_rng(9)
    for n in (200, 600, 2000):
        for part in (0.9, 0.8):
            d = int(n * (1 - part) / 2)
            pool = rng.integers(0, 1 << 63, n + d, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[d:])
            apart = int(np.bitwise_count((jaccard_tiles.bitmap(a) ^ jaccard_tiles.bitmap(b)).view(np.uint64)).sum())
            assert apart <= 2 * d and (2 * d > 150 or apart > 0.7 * 2 * d)
            if n > 256:
                wide = jaccard_tiles.bits_apart(jaccard_tiles.wide_bitmap(a), jaccard_tiles.wide_bitmap(b))
                assert 0.8 * 2 * d < wide <= 2 * d
