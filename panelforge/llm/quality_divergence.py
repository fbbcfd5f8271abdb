"""Quality rules by distribution divergence.

The references are learned from the corpus itself: per language, the histogram of
character classes and of the most common words over all documents. Each document's two
histograms are compared with its language's by the Jensen-Shannon distance (base 2, 0 to
1); a document that is too far from its own language's reference is rejected unless it is
near another one's (a wrong language label is no fault of the text). Documents below the
minimum length are not judged by the distances, which say little on few words.

Words are counted in tasks and summed by Spark; only the references (a few hundred numbers
per language) reach the driver.

Defined results: null texts count as empty; empty and short texts fail the base rule of 50
words; a null, empty or rare language uses the reference of all documents; repeated rows are
judged each; an empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, pick, slices

# Symbols of the base counts.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "other", "wide")


def _class_table() -> np.ndarray:
    t = np.full(256, CLASSES.index("other"), dtype=np.uint8)
    for name, members in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                          ("digit", b"0123456789"), ("space", b" \t\r\x0b\x0c"), ("newline", b"\n"),
                          ("stop", b".,;:!?'\"()-"), ("symbol", SYMBOLS)):
        t[list(members)] = CLASSES.index(name)
    t[128:] = CLASSES.index("wide")
    return t


CLASS_OF = _class_table()


def class_histogram(raw: bytes) -> np.ndarray:
    """Bytes per character class (a wide character counts by its bytes)."""
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence (base 2) of two histograms; 0 if either
    is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(d, 0.0) / 2))


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = raw.split()  # bytes are split at ASCII white space only
    n, inside = len(words), b"".join(words)
    symbols = len(inside) - len(inside.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else []
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, last = Counter(windows), -1
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 2 - max(i - 1, last)
                last = i + 2
    return n, len(inside.decode()), symbols, len(lines) - len(set(lines)), repeated


def references(docs: DataFrame, common_words: int = 100, min_documents: int = 20, text_col: str = "text",
               lang_col: str = "lang") -> dict[str, tuple[dict[bytes, int], np.ndarray, np.ndarray]]:
    """language ('' for all documents) -> (word -> bin, word histogram with the rest last,
    class histogram), counted over all documents."""
    schema = "lang string, word binary, n long"
    arrow = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def flush(held):
        rows = [(g, w, c) for (g, _), k in held.items() for w, c in k.items()]
        cols = list(zip(*rows)) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    def count(batches):
        held: dict = {}
        for part, raws in slices(batches, 0):
            for raw, g in zip(raws, part.column(1).to_pylist()):
                mine = held.setdefault((g, 0), Counter())
                mine.update(raw.lower().split())
                total = held.setdefault((g, 1), Counter())
                for name, v in zip(CLASSES, class_histogram(raw)):
                    total[b" " + name.encode()] += int(v)  # no word begins with a space
                total[b" words"] += len(raw.split())
                total[b" docs"] += 1
                if len(mine) > 200_000:
                    yield flush(held)
                    held = {}
        yield flush(held)

    counts = pick(docs, text=text_col, lang=lang_col).mapInArrow(count, schema)
    by = materialize(docs.sparkSession, counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "quality-counts")
    both = by.where("lang <> ''").union(by.groupBy(F.lit("").alias("lang"), "word").agg(F.sum("n").alias("n")))
    is_word = F.col("word") > F.lit(b" ~")
    top = F.row_number().over(Window.partitionBy("lang", is_word).orderBy(F.desc("n"), "word"))
    kept = both.withColumn("r", top).where(f"r <= {common_words}").select("lang", "word", "n").collect()
    out = {}
    for lang in {r["lang"] for r in kept}:
        mine = {bytes(r["word"]): r["n"] for r in kept if r["lang"] == lang}
        total, n_docs = mine.pop(b" words", 0), mine.pop(b" docs", 0)
        classes = np.array([mine.pop(b" " + c.encode(), 0) for c in CLASSES], "f8")
        if lang == "" or n_docs >= min_documents:
            words = sorted(mine, key=lambda w: (-mine[w], w))
            hist = np.array([mine[w] for w in words] + [total - sum(mine.values())], "f8")
            out[lang] = ({w: i for i, w in enumerate(words)}, hist, classes)
    return out


def distances(raw: bytes, reference) -> tuple[float, float]:
    index, words, classes = reference
    get, rest = index.get, len(index)
    mine = np.bincount([get(w, rest) for w in raw.lower().split()] or [rest], minlength=rest + 1)
    return js_distance(mine, words), js_distance(class_histogram(raw), classes)


def judge(spark: SparkSession, docs: DataFrame, max_word_distance: float = 0.45, max_class_distance: float = 0.2,
          min_words: int = 50, common_words: int = 100, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """One row per document: the base counts, base_failed, word_distance, class_distance and
    kept."""
    refs = spark.sparkContext.broadcast(references(docs, common_words, text_col=text_col, lang_col=lang_col))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = ("doc_id long, " + ", ".join(f"{n} long" for n in names) +
              ", base_failed boolean, word_distance double, class_distance double, kept boolean")
    arrow = pa.schema([("doc_id", pa.int64())] + [(n, pa.int64()) for n in names] +
                      [("base_failed", pa.bool_()), ("word_distance", pa.float64()), ("class_distance", pa.float64()),
                       ("kept", pa.bool_())])

    def run(batches):
        ref = refs.value
        for part, raws in slices(batches, 1):
            rows = []
            for doc, raw, lang in zip(part.column(0).to_pylist(), raws, part.column(2).to_pylist()):
                base = base_counts(raw)
                failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
                far = distances(raw, ref.get(lang) or ref[""])
                kept = base[0] < min_words or (far[0] <= max_word_distance and far[1] <= max_class_distance) or any(
                    w <= max_word_distance and c <= max_class_distance
                    for w, c in (distances(raw, r) for g, r in ref.items() if g != lang))
                rows.append((doc, *base, failed, *far, kept and not failed))
            cols = list(zip(*rows)) if rows else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return pick(docs, doc_id=id_col, text=text_col, lang=lang_col).mapInArrow(run, schema)
