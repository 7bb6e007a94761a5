"""Queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embedding_dedup, exact_dedup, language_id, order_minhash, packing, secret_scan, sentencepiece_codec, substring_dedup, url_filter
from .url_filter import Rule

RULES = [
    Rule("com", "/en/", "block"), Rule("example.com", "/en/7", "allow"), Rule("net", "/de/", "allow"),
    Rule("example.net", "/de/8", "block"), Rule("org", "/es/", "block"),
]
#: A conversation that every input gets: both texts are made of the template's control strings.
HARD = "\\### Assistant: </turn> ok"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out()))
    return language_id.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD).alias("text"))
    return chat.digests(chat.format_chats(turns.unionByName(hard)))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(_read(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_read(spark, sf_dir, "documents"), keep_text=False)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(_read(spark, sf_dir, "documents"))


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of op6: counts and spans of the fixed patterns."""
    return op6_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest_docs(_read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_read(spark, sf_dir, "pages"), RULES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_dedup(_read(spark, sf_dir, "documents")).drop("text_key")


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_chat_format, op3_embedding_dedup, op4_substring_dedup, op5_exact_dedup,
    op6_secret_scan, op7_sentencepiece, op8_url_filter, op9_packing, op10_minhash_dedup, base_secrets,
)}

_ESC = r"replace(replace(replace(text, '\', '\s'), '#', '\h'), '<', '\l')"
_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["'']?[ ]*[:=][ ]*["'']?([A-Za-z0-9+/_.=-]+)"""
# matches and what lies between them, in turn; a match starts after all that comes before it
_FOUND = "\n  UNION ALL ".join(
    f"SELECT r, '{kind}' AS kind, {k} AS o, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS ps, {least} AS least FROM t"
    for k, (kind, p, least) in enumerate((("assign", _ASSIGN, 6), ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)))
)
ORACLE_SQL = {
    "base_secrets": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
u AS (SELECT r, kind, o, least, unnest(ms) AS m, unnest(list_transform(ms, lambda x: length(x))) AS n, unnest(list_transform(ps[:len(ms)], lambda x: length(x))) AS gap, generate_subscripts(ms, 1) AS k FROM f),
p AS (SELECT *, sum(gap) OVER w + sum(n) OVER w AS e FROM u WINDOW w AS (PARTITION BY r, kind ORDER BY k)),
s AS (SELECT r, kind, o, e - n AS b, e FROM p WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, '{_ASSIGN}$', 1)) ELSE n END >= least),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS x, count(*) FILTER (kind = 'access') AS y, count(*) FILTER (kind = 'hex') AS z,
  string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, o) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(x, 0) AS n_assign, coalesce(y, 0) AS n_access, coalesce(z, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM t LEFT JOIN a USING (r)""",
    "op2_chat_format": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESC}) + 7 + CASE WHEN opens THEN 5 + length(replace({_ESC.replace("text", "role")}, chr(10), '\n')) ELSE 0 END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id""",
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a)
SELECT r.a AS vec_id, (SELECT count(*) FROM l WHERE l.a = r.a) AS n_links, min(c) AS component_id, r.a = min(c) AS kept FROM r GROUP BY r.a""",
    "op4_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
g AS (SELECT doc_id, i, CASE WHEN count(*) OVER x = 35 THEN md5(string_agg(word, ' ') OVER x) END AS h FROM w WINDOW x AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
d AS (SELECT doc_id, i, h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 AS rep FROM g),
m AS (SELECT w.doc_id, w.i, w.word, coalesce(max(CASE WHEN d.rep THEN 1 ELSE 0 END) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone FROM w JOIN d ON d.doc_id = w.doc_id AND d.i = w.i),
k AS (SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN k USING (doc_id)""",
    "op5_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM t""",
    "op8_url_filter": r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
r(h, p, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
f AS (SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT u.page_id, host, path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM u LEFT JOIN f ON f.page_id = u.page_id AND k = 1""",
}
