"""One query per operator over its whole table, with production parameters, and DuckDB SQL
for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (best_fit, collocations, cube_mixing, hnsw_dedup, jaccard_tiles, kd_shards, laesa_codes, orc_tokens,
               pii_surrogates, quality_divergence, secret_scan, suffix_dedup, toxicity_kn)
from .common import table


def vocabulary() -> str:
    """The public byte-level BPE file that the packing queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(spark, table(spark, sf_dir, "documents"), vocabulary())[1]


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(spark, table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", of)).cast("long").alias(name) for name, of in (
        ("n_assign", lambda s: s["kind"] == "assign"), ("n_access", lambda s: s["kind"] == "access"),
        ("n_hex", lambda s: s["kind"] == "hex"))]
    return found.select("doc_id", *counts, F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.written(F.col("spans")).alias("spans"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace_pii(spark, table(spark, sf_dir, "documents"), "key of this query")


def op5_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards.kd_shards(spark, table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_divergence.judge(spark, table(spark, sf_dir, "documents"))


def op7_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fitted = toxicity_kn.fit(spark, docs, table(spark, sf_dir, "labels"),
                             learn_from=~toxicity_kn.held_out(F.col("doc_id")))
    return toxicity_kn.score_columns(spark, docs, fitted)


def op8_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cube_mixing.mix(spark, table(spark, sf_dir, "documents"), payload=["doc_id"])
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      "kept_sha256")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_tiles.jaccard_classes(spark, table(spark, sf_dir, "documents"))


def op11_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "orc-tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return orc_tokens.checksums(orc_tokens.read_tokens(spark, path))


def op12_laesa_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = laesa_codes.compress(spark, table(spark, sf_dir, "embeddings"))
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(laesa_codes.digest(books)).alias("codebooks_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_best_fit_packing, op3_secret_scan, op4_pii_surrogates, op5_kd_tree_sharding,
    op6_quality_divergence, op7_toxicity_kneser_ney, op8_cube_mixing, op9_suffix_dedup, op10_jaccard_join,
    op11_orc_token_ids, op12_laesa_vector_codes, op13_phrase_collocations)}


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain rounds of nearest entries and floored means, one pair of tables a round."""
    ctes = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT rid, vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x
  FROM kept, range({parts}) t(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM part
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
)"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, p, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT rid, part.p, e, list_sum(list_transform(list_zip(part.x, c{i}.x),
      lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM part JOIN c{i} USING (p)) s GROUP BY rid, p
)""")
        if i < rounds:
            ctes.append(f"""m{i} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM (
    SELECT p, best.e AS e, pos, sum(x[pos])::BIGINT AS s, count(*) AS n
    FROM part JOIN a{i} USING (rid, p), LATERAL (SELECT unnest(range(1, len(x) + 1)) AS pos) t GROUP BY ALL) g
  GROUP BY p, e
), c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.p = c.p AND m.e = c.e
)""")
    return f"""WITH {", ".join(ctes)}, coded AS MATERIALIZED (
  SELECT rid, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM a{rounds} GROUP BY rid
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM c{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT h FROM books) AS codebooks_sha256
FROM kept JOIN coded USING (rid)"""


ORACLE = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c USING (vec_id) LEFT JOIN n USING (vec_id)
""",
    "op9_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
w AS (
  SELECT doc_id, s.i AS pos, md5(raw[s.i:s.i + 199]) AS h
  FROM d, LATERAL (SELECT unnest(range(1, octet_length(raw) - 198)) AS i) s
), again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, pos FROM w WHERE h IN (SELECT h FROM again)),
edge AS (
  SELECT doc_id, pos, CASE WHEN pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 200
    OR lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) IS NULL THEN 1 ELSE 0 END AS new
  FROM hit
), grp AS (SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM edge),
span AS (SELECT doc_id, g, min(pos) AS a, max(pos) + 200 AS b FROM grp GROUP BY doc_id, g),
gap AS (
  SELECT doc_id, a AS pos, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS a, a AS b FROM span
), kept AS (
  SELECT g.doc_id, string_agg(hex(raw[g.a:g.b - 1]), '' ORDER BY g.pos) AS body
  FROM gap g JOIN d USING (doc_id) WHERE g.b > g.a GROUP BY g.doc_id
), sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM span GROUP BY doc_id)
SELECT d.doc_id, octet_length(raw)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k.body, '') || hex(raw[coalesce(s.last, 1):octet_length(raw)]))) AS kept_sha256
FROM d LEFT JOIN sums s USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), items AS (SELECT doc_id, unnest(s) AS x FROM shingles),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT c.a, c.b FROM common c JOIN shingles p ON p.doc_id = c.a JOIN shingles q ON q.doc_id = c.b
  WHERE 100 * c.n >= 90 * (len(p.s) + len(q.s) - c.n)
), pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN pairs l ON l.a = r.b
), comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id FROM shingles s JOIN comp c USING (doc_id)
""",
    "op12_laesa_vector_codes": _vector_codes_sql(),
    "op13_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, w[i:i + k - 1] AS g FROM lists, range(1, 6) t(k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i) s
), f AS MATERIALIZED (SELECT lang, g, count(*) AS a FROM grams GROUP BY lang, g),
total AS (SELECT lang, sum(a)::HUGEINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE len(g) > 1 AND a >= 100),
cuts AS (
  SELECT c.lang, c.g, c.a, t.n, k, x.a AS l, y.a AS r, (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
  FROM cand c JOIN total t USING (lang), range(1, 5) s(k), f x, f y
  WHERE k < len(c.g) AND x.lang = c.lang AND x.g = c.g[1:k] AND y.lang = c.lang AND y.g = c.g[k + 1:len(c.g)]
), low AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS nth FROM cuts
), inside AS (
  SELECT DISTINCT d.lang, d.g[i:i + m - 1] AS g, d.a AS longer FROM cand d, range(2, 5) t(m),
    LATERAL (SELECT unnest(range(1, len(d.g) - m + 2)) AS i) s WHERE m < len(d.g)
), out AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM low
  WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = low.lang AND i.g = low.g AND 100 * i.longer >= 100 * low.a)
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, * EXCLUDE (lang) FROM out
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
""",
}
