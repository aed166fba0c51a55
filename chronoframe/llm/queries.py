"""Queries over the standard tables, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, clustering, decontamination, embedding_dedup, language_id, line_dedup, media, ngram_join, packing, quality, url_filter, warc

URL_RULES = (
    url_filter.Rule("com", "/en/", "block"),
    url_filter.Rule("example.com", "/en/7", "allow"),
    url_filter.Rule("net", "/de/", "allow"),
    url_filter.Rule("example.net", "/de/8", "block"),
    url_filter.Rule("org", "/es/", "block"),
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, language_id.learnable(F.col("doc_id"), 3, 1))
    told = language_id.classify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, language_id.learnable(F.col("doc_id"), 4, 2))
    told = quality.score(docs.select("doc_id", "text"), model)
    return told.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_join, op2_packing, op3_line_dedup, op4_media, op5_warc, op6_byte_bpe, op7_embedding_dedup, op8_url_filter, op9_language_id, op10_quality, op11_alignment, op12_decontamination, op13_clustering)
}

def _clustering_sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Lloyd's rounds, each a pair of common table expressions over (vector, component) rows."""
    out = f"""WITH kept AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {dim}),
v AS MATERIALIZED (SELECT r, unnest(range({dim})) AS d, unnest([CAST(floor({scale} * x) AS BIGINT) FOR x IN e]) AS x FROM kept),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept WHERE vec_id IS NOT NULL),
c0 AS MATERIALIZED (SELECT c, d, x FROM v JOIN s ON v.r = s.r WHERE c < {k})"""
    for i in range(rounds + 1):
        out += f""",
f{i} AS (SELECT r, c, sum((v.x - c.x) * (v.x - c.x)) AS far FROM v JOIN c{i} c ON v.d = c.d GROUP BY r, c),
a{i} AS MATERIALIZED (SELECT r, c, far FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY far, c) AS k FROM f{i}) WHERE k = 1)"""
        if i < rounds:
            out += f""",
m{i} AS (SELECT a.c, v.d, sum(v.x) AS s, count(*) AS n FROM v JOIN a{i} a ON v.r = a.r GROUP BY a.c, v.d),
c{i + 1} AS MATERIALIZED (SELECT c.c, c.d, CASE WHEN s IS NULL THEN c.x WHEN s % n < 0 THEN (s - s % n) // n - 1 ELSE (s - s % n) // n END AS x FROM c{i} c LEFT JOIN m{i} m ON c.c = m.c AND c.d = m.d)"""
    return out + f""",
t AS (SELECT c, sum(far) AS s FROM a{rounds} GROUP BY c),
h AS (SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM kept JOIN a{rounds} a ON kept.r = a.r JOIN t ON a.c = t.c JOIN h ON a.c = h.c"""


#: The components need transitive closure; hash and token digests and trained models have no SQL. Those are held
#: against brute force in tests/llm.
ORACLE_SQL = {
    "op8_url_filter": r"""
WITH parts AS (
  SELECT page_id, url,
         CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN NULL ELSE substr(url, position('://' IN url) + 3) END AS rest
  FROM pages),
cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
best AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM cut JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT c.page_id, c.host, c.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM cut c LEFT JOIN best b ON c.page_id = b.page_id
""",
    "op5_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
t AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN t.top IS NULL OR t.top = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN t.top IS NULL OR t.top = p.page_id THEN NULL ELSE t.top END AS refers_to
FROM p LEFT JOIN t ON p.payload_bytes >= 1000 AND p.payload_digest = t.payload_digest
""",
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN n ON v.vec_id = n.x JOIN c ON v.vec_id = c.x
""",
    "op12_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s : s + 9], ' ') AS p FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
grams AS (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS p FROM places),
hits AS (SELECT r, s, grams.n, item_id FROM grams JOIN win ON grams.p = win.p),
words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(s, s + n)) AS q FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words ON d.r = words.r LEFT JOIN items ON d.r = items.r
""",
    "op13_clustering": _clustering_sql(),
}
