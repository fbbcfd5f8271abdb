"""Secret scan with corpus-wide ownership frequency.

Every whole text is scanned once in Arrow batches for candidate strings. Their hashes are
then aggregated over the corpus: in how many repositories (distinct contents, so that
copies of one file count once) and with how many owners (sources) each occurs. A candidate
that many owners hold in many repositories is a widely copied example; any other base
span, and any other further candidate that looks random, is a live-looking credential. Base
spans are always reported; the method adds a ``live`` span for each live-looking candidate
that no base span covers.

Aggregation is partial per (hash, owner, repository) and never gathers a candidate's rows;
the text itself is not shuffled.

Defined results: null or empty texts have no spans; a null source is one owner; repeated
rows are scanned and returned each; an empty table gives no rows; extra columns are
ignored."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pick

# The base patterns. Keyword letters match in either case, ASCII only.
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Further candidates, reported only when live-looking: long mixed tokens, URL passwords.
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
URL_PASSWORD = re.compile(r"://[^\s:@/]++:([^\s:@/]{6,}+)@")
KINDS = ("assign", "access", "hex", "live")


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the three base kinds, leftmost and non-overlapping
    within each kind; ends are exclusive, in code points."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 6:
            out.append(("assign", m.start(), m.end(), m[1]))
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return out


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    """Digits mixed with letters and enough distinct characters to be a generated secret."""
    return (any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= 2.5)


def extra_spans(text: str) -> list[tuple[str, int, int, str]]:
    out = [("live", m.start(1), m.end(1), m[1]) for m in URL_PASSWORD.finditer(text)] if "://" in text else []
    return out + [("live", m.start(), m.end(), m[0]) for m in MIXED.finditer(text)
                  if entropy(m[0]) >= 3.5 and any(c.isdigit() for c in m[0]) and any(c.isupper() for c in m[0])]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("h", pa.int64()),
                   ("random", pa.bool_())])
_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("content", pa.int64()), ("owner", pa.string()), ("repo", pa.int64()),
                    ("found", pa.list_(_SPAN))])
_DDL = ("row long, doc_id long, content long, owner string, repo long, "
        "found array<struct<kind: string, start: long, stop: long, h: long, random: boolean>>")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """One row per document: row, doc_id, content hash, owner, repo, found spans."""
    def hashed(value: str) -> int:
        return xxhash.xxh3_64_intdigest(value.encode()) - (1 << 63)

    def run(batches):
        for batch in batches:
            found, repos = [], []
            for text in batch.column("text"):
                t = text.as_py() or ""
                spans = base_spans(t) + extra_spans(t)
                repos.append(hashed(t) if spans else 0)
                found.append([{"kind": k, "start": s, "stop": e, "h": hashed(v), "random": looks_random(v)}
                              for k, s, e, v in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").cast(pa.int64()), batch.column("doc_id").cast(pa.int64()), batch.column("content"),
                 batch.column("owner").cast(pa.string()), pa.array(repos, pa.int64()),
                 pa.array(found, pa.list_(_SPAN))], schema=_ARROW)

    return (pick(docs, doc_id=id_col, text=text_col, owner=owner_col)
            .withColumn("content", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, _DDL))


def ownership(found: DataFrame, min_owners: int = 3, min_repos: int = 5) -> DataFrame:
    """Per candidate hash: owners, repositories and whether it is a widely copied example."""
    flat = found.select("owner", "repo", F.explode("found.h").alias("h"))
    per = flat.groupBy("h", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = per.groupBy("h", "owner").agg(F.count(F.lit(1)).alias("c")).groupBy("h").agg(
        F.count(F.lit(1)).alias("n_owners"))
    repos = per.groupBy("h", "repo").agg(F.count(F.lit(1)).alias("c")).groupBy("h").agg(
        F.count(F.lit(1)).alias("n_repos"))
    return owners.join(repos, "h").withColumn(
        "example", (F.col("n_owners") >= min_owners) & (F.col("n_repos") >= min_repos))


def scan(spark: SparkSession, docs: DataFrame, min_owners: int = 3, min_repos: int = 5, **columns: str) -> DataFrame:
    """One row per document: doc_id, row, content, base (base spans) and spans (base and live spans),
    arrays of (start, ord, kind, stop, live, n_owners, n_repos) in order."""
    found = materialize(spark, candidates(docs, **columns), "secrets")
    judged = (found.where("size(found) > 0").select("row", F.explode("found").alias("s"))
              .select("row", "s.*").join(ownership(found, min_owners, min_repos), "h")
              .withColumn("live", F.expr("not example and (random or kind <> 'live')"))
              .withColumn("ord", F.expr("array_position(array('assign', 'access', 'hex', 'live'), kind)")))
    item = F.struct("start", "ord", "kind", "stop", "live", "n_owners", "n_repos")
    base = F.collect_list(F.when(F.col("kind") != "live", item))
    extra = F.collect_list(F.when((F.col("kind") == "live") & F.col("live"), item))
    per = judged.groupBy("row").agg(F.sort_array(base).alias("base"), extra.alias("extra"))
    per = per.withColumn("extra", F.filter("extra", lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) &
                                                                        (x["start"] < b["stop"]))))
    per = per.select("row", "base", F.sort_array(F.array_distinct(F.concat("base", "extra"))).alias("spans"))
    none = F.array().cast(per.schema["base"].dataType)
    return found.select("row", "doc_id", "content").join(per, "row", "left").select(
        "doc_id", "row", "content", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def written(spans) -> "F.Column":
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The base digest of plain tuples (used by the tests)."""
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in ordered).encode()).hexdigest()


def mask(spark: SparkSession, docs: DataFrame, placeholder: str = "<secret>", id_col: str = "doc_id",
         text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with every live-looking span (base or added) replaced in the text, whatever the
    letters of a base span's value; widely copied examples and clean documents stay as they are. ``n_chars`` follows if present."""
    found = scan(spark, docs, id_col=id_col, text_col=text_col, **kw)
    # documents of one id and content have the same spans, so they share a row of hits
    hits = found.select("doc_id", "content", F.explode("spans").alias("s")).where("s.live").groupBy(
        "doc_id", "content").agg(F.sort_array(F.collect_set(
            F.struct(F.col("s.start").alias("start"), F.col("s.stop").alias("stop")))).alias("hits"))
    hits = hits.toDF("mask__id", "mask__content", "mask__hits")
    cut = docs.join(hits, F.col(id_col).eqNullSafe(F.col("mask__id")) &
                    (F.xxhash64(text_col) == F.col("mask__content")), "left")
    # left to right: (text so far, where the copied part ends); overlapping spans mask once
    text = F.col(text_col)
    done = F.aggregate(
        "mask__hits", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, h: F.when(h["stop"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], F.when(h["start"] >= acc["at"], F.concat(
                text.substr((acc["at"] + 1).cast("int"), (h["start"] - acc["at"]).cast("int")), F.lit(placeholder)))
                .otherwise(F.lit(""))).alias("out"), h["stop"].alias("at"))),
        lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text))))
    cut = cut.withColumn(text_col, F.when(F.col("mask__hits").isNull() | text.isNull(), text).otherwise(done))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("mask__hits").isNull(), F.col("n_chars"))
                             .otherwise(F.length(text_col).cast(docs.schema["n_chars"].dataType)))
    return cut.select(*docs.columns)
