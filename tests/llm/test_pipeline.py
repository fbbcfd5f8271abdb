import random

import numpy as np
import pytest

import corpus_pipeline as P
from panelforge.llm import best_fit, toxicity_kn
from panelforge.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF).cache()
        if name != "packing":
            assert out.columns == docs.columns and out.count() > 0
        if name in ("toxicity", "near_duplicates"):
            assert out.count() == out.select("doc_id").distinct().count() <= docs.count()
        if name == "secrets":
            assert out.count() == docs.count()
        kept[name] = docs = out
    mixed = kept["mixing"]
    enc, tokens = best_fit.encoder(vocabulary()), 0
    for r in mixed.collect():
        tokens += len(enc.encode_ordinary(r.text or "")) + 1
    pieces = kept["packing"].collect()
    assert sum(r.length for r in pieces) == tokens
    assert max(r.offset + r.length for r in pieces) <= 2048
    assert np.unique([r.sequence_id for r in pieces]).size <= 1.02 * -(-tokens // 2048) + 1


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert [n for n, _ in P.STAGES][0] == "toxicity" and toxicity_kn.WINDOW == 8


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = [None, "", "one two"]
    for n in (8, 30, 90, 240):
        one = [rng.choice(words) for _ in range(n)]
        texts.append(" ".join(one))
        for edits in sorted({1, n // 57 + 1, n // 45, n // 30}):  # scattered edits
            x = list(one)
            for k in range(edits):
                x[(2 * k + 1) * n // (2 * edits)] = f"new{k}"
            texts.append(" ".join(x))
        texts.append(" ".join(one[:n // 2] + [f"b{k}" for k in range(n // 12)] + one[n // 2 + n // 12:]))  # a block replaced
        texts.append(" ".join(one + [f"c{k}" for k in range(n // 6)]))                                   # a block added
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in ((t or "").split() for t in texts)]
    comp = list(range(len(sets)))
    for _ in range(6):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 10 * len(a & b) >= 8 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = P.near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, c in enumerate(comp) if i == c]
    assert sum(c != i for i, c in enumerate(comp)) > 8


DDL = "doc_id long, text string, lang string, source string, n_chars long, Text int, DOC_ID string, c0 int, size string"


def _odd_rows():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", " \n", "password = hunter2hunter2", prose(20_000), prose(40), prose(40)] + [prose(30) for _ in range(20)]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None if t is None else len(t), i, "x", 1, "y")
            for i, t in enumerate(texts)]
    return rows + [rows[5], (None, "no id " + prose(30), "en", "s1", None, 0, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stages_take_nulls_long_texts_repeats_and_clashing_names(spark, name, stage):
    rows = _odd_rows()
    docs = spark.createDataFrame(rows, DDL).repartition(2)
    out = stage(spark, docs, SF)
    got = [tuple(r) for r in out.collect()]
    if name == "packing":
        assert {r.doc_id for r in out.collect()} == {r[0] for r in rows}
        return
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    if name == "secrets":
        left = sorted(map(str, set(rows) - set(got)))
        assert len(got) == len(rows) and left == [str(rows[3])]
    else:
        assert set(got) <= set(rows)
    if name in ("toxicity", "near_duplicates"):
        assert len(got) == len(rows)  # all clean; rows of one doc_id stay together


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stages_of_an_empty_table(spark, name, stage):
    assert stage(spark, spark.createDataFrame([], DDL), SF).count() == 0
