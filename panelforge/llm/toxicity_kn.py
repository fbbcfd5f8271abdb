"""Toxicity by class-conditional Kneser-Ney bigram models.

Two interpolated Kneser-Ney models, of toxic and of ordinary labelled documents, back off
from bigrams to class-conditional continuation counts and from these to shared counts:
continuation counts of both classes, with a prior from how many documents of the whole
corpus, labelled or not, hold the word; so a rare expression costs both classes alike. A document's
evidence is the length-normalised log-likelihood ratio: per word, per square root of
length, in its strongest window, and the excess of its strong single words; a logistic regression on labelled documents that the
counts have not seen turns it into a score.

Counts are summed by Spark, and the probabilities are joins and sums over the count
tables. The class counts come from at most ``max_rows`` labelled documents per class (the
ones with the smallest hash of their id), which bounds the tables that are broadcast; the
corpus counts cover every document and grow with it, and stay a distributed table. All
documents are scored, in one pass without a shuffle.

Defined results: null or empty texts have ratio 0 and get the score of no evidence;
documents without label are scored, not learned from; a label counts as toxic if any row
says so, null labels are ignored; without labels of both classes every score is the base
rate (0.5 without any); repeated rows are scored each; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import materialize, pick, slices

WINDOW = 8
STRONG = 2.3
# ASCII letters and digits and all wide bytes make words; everything else separates them.
_TO_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))
START = 0x51AB
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


class _Words:
    """Word hashes with a bounded cache."""

    def __init__(self, limit: int = 150_000):
        self.limit, self.known = limit, {}

    def ids(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(context, word) hashes of all words of all texts, and the word count of each text."""
        if len(self.known) > self.limit:
            self.known = {}
        known, digest, out, counts = self.known, xxhash.xxh3_64_intdigest, [], []
        for raw in raws:
            words = raw.translate(_TO_WORDS).split()
            counts.append(len(words))
            if words:
                out.append(START)
                for w in words:
                    h = known.get(w)
                    if h is None:
                        h = known[w] = digest(w)
                    out.append(h)
        ids = np.array(out, dtype=np.uint64)
        counts = np.array(counts, dtype=np.int64)
        first = np.zeros(len(ids), bool)
        starts = np.cumsum(counts[counts > 0] + 1) - (counts[counts > 0] + 1)
        first[starts] = True
        at = np.flatnonzero(~first)
        return np.stack([ids[at - 1], ids[at]]) if len(at) else np.zeros((2, 0), np.uint64), counts


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = (v * _MIX) ^ (w + (v >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def bigram_counts(texts: DataFrame) -> DataFrame:
    """(text, toxic) -> v, w, t, o: how often word hash w follows v in toxic and in ordinary
    texts."""
    arrow = pa.schema([("v", pa.int64()), ("w", pa.int64()), ("t", pa.int64()), ("o", pa.int64())])

    def run(batches):
        words = _Words()
        for part, raws in slices(batches, 0):
            (v, w), counts = words.ids(raws)
            label = np.repeat(part.column(1).to_numpy(), counts)
            order = np.lexsort((w, v))
            v, w, label = v[order], w[order], label[order]
            new = np.ones(len(v), bool)
            new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
            at = np.flatnonzero(new)
            t = np.add.reduceat(label, at) if len(at) else label
            n = np.diff(np.append(at, len(v)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                v[at].view(np.int64), w[at].view(np.int64), t, n - t)], schema=arrow)

    return texts.mapInArrow(run, "v long, w long, t long, o long").groupBy("v", "w").agg(
        F.sum("t").alias("t"), F.sum("o").alias("o"))


def document_counts(texts: DataFrame) -> DataFrame:
    """(text) -> w, n: how many texts hold word hash w."""
    arrow = pa.schema([("w", pa.int64()), ("n", pa.int64())])

    def run(batches):
        words = _Words()
        for _, raws in slices(batches, 0):
            (_, w), counts = words.ids(raws)
            at = np.repeat(np.arange(len(raws)), counts)
            order = np.lexsort((at, w))
            w, at = w[order], at[order]
            new = np.ones(len(w), bool)
            new[1:] = (w[1:] != w[:-1]) | (at[1:] != at[:-1])
            w, n = np.unique(w[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], schema=arrow)

    return texts.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the counts of counts;
    0.5, 1 and 1.5 where these are too few."""
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return (min(max(1 - 2 * y * n2 / n1, 0.1), 0.98), min(max(2 - 3 * y * n3 / n2, 0.2), 1.9),
            min(max(3 - 4 * y * n4 / n3, 0.3), 2.8) if n3 else 1.5)


def discount(c: Column, d: tuple[float, float, float]) -> Column:
    return F.when(c == 0, F.lit(0.0)).when(c == 1, F.lit(d[0])).when(c == 2, F.lit(d[1])).otherwise(F.lit(d[2]))


def kneser_ney(spark: SparkSession, counts: DataFrame, corpus: DataFrame) -> dict[str, np.ndarray]:
    """Log ratios toxic / ordinary: of seen bigrams, of the back-off weight of contexts, of
    single words, and of a word never seen. ``corpus`` holds the ``document_counts`` of all texts."""
    b = materialize(spark, counts, "kn-bigrams")
    tally = lambda col, n: F.sum(F.when(F.col(col) == n, 1).otherwise(0)).alias(f"{col}{n}")
    types = b.agg(*[tally(c, n) for c in "to" for n in (1, 2, 3, 4)],
                  *[F.sum((F.col(c) > 0).cast("long")).alias(f"types_{c}") for c in "to"],
                  F.count(F.lit(1)).alias("types")).first()
    d = {c: discounts(*[types[f"{c}{n}"] for n in (1, 2, 3, 4)]) for c in "to"}
    # continuation counts of words by class, backing off to those of both classes together
    words = materialize(spark, b.groupBy("w").agg(
        *[F.sum((F.col(c) > 0).cast("long")).alias(f"k_{c}") for c in "to"], F.count(F.lit(1)).alias("k")), "kn-words")
    singles = words.agg(F.count(F.lit(1)).alias("v"), *[tally(f"k_{c}", n) for c in "to" for n in (1, 2, 3, 4)],
                        *[F.sum((F.col(f"k_{c}") > 2).cast("long")).alias(f"more_{c}") for c in "to"]).first()
    # the shared level: continuation counts of both classes, one per word, and another one per
    # word on average, dealt out by the share of the whole corpus's documents
    corpus = materialize(spark, corpus, "kn-corpus")
    whole = float(corpus.agg(F.sum("n")).first()[0])
    prior = F.coalesce("n", F.lit(0)) * F.lit(singles["v"] / whole)
    shared = (F.col("k") + 1.0 + prior) / F.lit(float(types["types"] + 2 * singles["v"] + 1))
    p, back = {}, {}
    for c in "to":
        e, n = discounts(*[singles[f"k_{c}{i}"] for i in (1, 2, 3, 4)]), float(types[f"types_{c}"])
        back[c] = (e[0] * singles[f"k_{c}1"] + e[1] * singles[f"k_{c}2"] + e[2] * singles[f"more_{c}"]) / n
        p[c] = (F.col(f"k_{c}") - discount(F.col(f"k_{c}"), e)) / F.lit(n) + F.lit(back[c]) * shared
    words = materialize(spark, words.join(corpus, "w", "left").select("w", p["t"].alias("p_t"), p["o"].alias("p_o")),
                        "kn-words-p")
    contexts = b.groupBy("v").agg(*[F.sum(c).alias(f"c_{c}") for c in "to"],
                                  *[F.sum(discount(F.col(c), d[c])).alias(f"d_{c}") for c in "to"])
    lam = {c: F.when(F.col(f"c_{c}") > 0, F.col(f"d_{c}") / F.col(f"c_{c}")).otherwise(F.lit(1.0)) for c in "to"}
    contexts = contexts.select("v", "c_t", "c_o", lam["t"].alias("l_t"), lam["o"].alias("l_o"))
    full = b.join(contexts, "v").join(words, "w")
    q = {c: F.when(F.col(f"c_{c}") > 0, (F.col(c) - discount(F.col(c), d[c])) / F.col(f"c_{c}")).otherwise(
        F.lit(0.0)) + F.col(f"l_{c}") * F.col(f"p_{c}") for c in "to"}

    def table(df: DataFrame, key: list[str], value: Column) -> tuple[np.ndarray, np.ndarray]:
        got = df.select(*key, F.log(value).cast("float").alias("r")).toArrow()
        k = [got.column(c).to_numpy().view(np.uint64) for c in key]
        k = pair_key(*k) if len(k) == 2 else k[0]
        order = np.argsort(k)
        return k[order], got.column("r").to_numpy()[order]

    out = {}
    out["pair"], out["pair_r"] = table(full, ["v", "w"], q["t"] / q["o"])
    out["word"], out["word_r"] = table(words, ["w"], F.col("p_t") / F.col("p_o"))
    out["context"], out["context_r"] = table(contexts, ["v"], F.col("l_t") / F.col("l_o"))
    out["new"] = np.array([np.log(back["t"] / back["o"])], "f4")
    return out


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit, values[at], np.float32(default)), hit


def evidence(raws: list[bytes], model: dict | None, words: _Words) -> np.ndarray:
    """Per text the log likelihood ratio toxic / ordinary: mean per word, sum / square root of
    length, strongest window, and what the single words' ratios exceed STRONG by (log)."""
    out = np.zeros((len(raws), 4))
    (v, w), counts = words.ids(raws)
    if model is None or not len(w):
        return out
    pair, seen = _look(model["pair"], model["pair_r"], pair_key(v, w), 0.0)
    miss = np.flatnonzero(~seen)
    single, _ = _look(model["word"], model["word_r"], w, float(model["new"][0]))
    context, _ = _look(model["context"], model["context_r"], v[miss], 0.0)
    r = pair.astype("f8")
    r[miss] = single[miss].astype("f8") + context
    full = np.flatnonzero(counts)
    stop = np.cumsum(counts[full])
    start = stop - counts[full]
    total = np.add.reduceat(r, start)
    n = counts[full]
    run = np.concatenate([[0.0], np.cumsum(r)])
    end = np.minimum(np.arange(len(r)) + WINDOW, np.repeat(stop, n))
    window = (run[end] - run[:-1]) / WINDOW
    out[full, 0], out[full, 1] = total / n, total / np.sqrt(n)
    out[full, 2] = np.maximum.reduceat(window, start)
    out[full, 3] = np.log1p(np.add.reduceat(np.maximum(single - STRONG, 0.0), start))
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> dict[str, np.ndarray]:
    """Ridge logistic regression by Newton steps on standardised columns."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    b = np.zeros(z.shape[1])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        b += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (y - p) - penalty @ b)
    return {"mean": mean, "scale": scale, "b": b}


def apply_logistic(fit: dict, x: np.ndarray) -> np.ndarray:
    z = fit["b"][0] + ((x - fit["mean"]) / fit["scale"]) @ fit["b"][1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = 5000, id_col: str = "doc_id",
        text_col: str = "text", learn_from: Column | None = None) -> dict:
    """The model of ``score``. ``labels`` (doc_id, toxic); ``learn_from`` is a condition on
    doc_id. A fifth of the labelled documents is kept for the regression. The texts of all
    ``docs`` feed the corpus counts, which know no labels."""
    lab = pick(labels, doc_id="doc_id", toxic="toxic").where("doc_id is not null and toxic is not null")
    if learn_from is not None:
        lab = lab.where(learn_from)
    lab = lab.groupBy("doc_id").agg((F.max("toxic") > 0).cast("long").alias("toxic"))
    lab = materialize(spark, lab.withColumn("h", F.xxhash64("doc_id")).withColumn(
        "part", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5)) == 0).cast("int")), "kn-labels")
    # at most max_rows per class and part: a bounded table, broadcast to find their texts
    chosen = None
    for c in (0, 1):
        for part in (0, 1):
            some = lab.where((F.col("toxic") == c) & (F.col("part") == part)).orderBy("h").limit(max_rows)
            chosen = some if chosen is None else chosen.union(some)
    texts = pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen.drop("h")), "doc_id")
    texts = materialize(spark, texts.dropDuplicates(["doc_id"]), "kn-texts")
    learn = texts.where("part = 0").select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    both = lab.agg(F.avg("toxic")).first()[0]
    base = 0.5 if both is None else float(both)
    counts = bigram_counts(learn)
    seen = counts.agg(F.sum("t"), F.sum("o")).first() if len(sizes) == 2 else (0, 0)
    if not seen[0] or not seen[1]:
        return {"base": base, "model": None, "fit": None}
    model = kneser_ney(spark, counts, document_counts(pick(docs, text=text_col)))
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        words = _Words()
        for part, raws in slices(batches, 0):
            x = evidence(raws, held.value, words)
            yield pa.RecordBatch.from_arrays([*map(pa.array, x.T.copy()), part.column(1)], names=[*"abcd", "y"])

    for part in ("part = 1", "part = 0"):  # the counts' own texts only if none were kept
        got = texts.where(part).select("text", "toxic").mapInArrow(run, "a double, b double, c double, d double, y long").toArrow()
        y = got.column("y").to_numpy()
        if len(y) and 0 < y.sum() < len(y):
            break
    x = np.column_stack([got.column(c).to_numpy() for c in "abcd"])
    held.unpersist()
    return {"base": base, "model": model, "fit": logistic(x, y)}


def score(spark: SparkSession, docs: DataFrame, fitted: dict, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``out``: 0 to 1, higher when toxic is likelier."""
    held = spark.sparkContext.broadcast(fitted)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text_at = docs.columns.index(text_col)
    schema = StructType([StructField(n, f.dataType, True) for n, f in zip(names, docs.schema)] +
                        [StructField("score", DoubleType())])

    def run(batches):
        m, words = held.value, _Words()
        for part, raws in slices(batches, text_at):
            x = evidence(raws, m["model"], words)
            got = apply_logistic(m["fit"], x) if m["fit"] else np.full(len(raws), m["base"])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got)], names=[*names, "score"])

    return docs.toDF(*names).mapInArrow(run, schema).toDF(*docs.columns, out)


def score_columns(spark: SparkSession, docs: DataFrame, fitted: dict) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.7 on)."""
    scored = score(spark, pick(docs, doc_id="doc_id", text="text"), fitted).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))
