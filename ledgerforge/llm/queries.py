"""The registered corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerforge.llm import chat, common, decontam, langid, lm, media, mixing, neardup, pii, spelling, toxicity, trie, urlfilter, vectors
from ledgerforge.plans.registry import CRC_TABLE, crc32_sql

Query = Callable[[SparkSession, str], DataFrame]

#: action, host, path prefix
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(common.id_crc(4) != 2))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (common.id_crc(4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda side: F.array_join(F.transform(side, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(common.table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rules_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(common.table(spark, sf_dir, "conversations"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels").where(common.id_crc(5) != 0))
    return toxicity.score(docs, model).select("doc_id", (common.id_crc(5) == 0).alias("held_out"), "score", "predicted")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    scored = lm.fit_and_score(docs, common.id_crc(7) != 2)
    return scored.select("doc_id", (common.id_crc(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(common.table(spark, sf_dir, "documents"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.columns(common.table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.rebuilt(common.table(spark, sf_dir, "conversations")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.typed_words(common.table(spark, sf_dir, "documents")))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked_vectors(common.table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_pii, op3_decontamination, op4_mixing, op5_url_filter, op6_chat_format, op7_toxicity, op8_lm_scoring, op9_near_duplicates, op10_media,
        op11_prefix_trie, op12_spelling_variants, op13_near_vectors,
    )
}

_HOST = r"coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '')"

ORACLES: dict[str, str] = {
    "op5_url_filter": f"""
WITH rules(action, rhost, rpath) AS (VALUES {", ".join(str(r) for r in RULES)}),
p AS (SELECT row_number() OVER () AS n, page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
fits AS (
  SELECT n, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS place
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN fits ON p.n = fits.n AND place = 1""",
    "op11_prefix_trie": f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(coalesce(role, '')), md5(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t), {CRC_TABLE}),
r AS (
  SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place < h
  UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place >= h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, length(text) AS chars, md5(length(role) || ':' || role || text) AS step FROM r),
p AS (
  SELECT conv_id, depth, chars, md5(string_agg(step, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM d
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS up, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS (
  SELECT depth, key, min(conv_id) AS conv_id, any_value(up) AS up, any_value(chars) AS chars, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM q GROUP BY depth, key),
k AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n_children FROM n GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.depth = n.depth AND k.key = n.key),
s AS (
  SELECT p.depth, p.key, CAST(sum((n_convs - 1) * m.chars) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY ALL)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
FROM m JOIN s ON s.depth = m.depth AND s.key = m.key LEFT JOIN n u ON u.depth = m.depth - 1 AND u.key = m.up""",
    "op12_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
each AS (SELECT id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, k, {crc32_sql("(id || ':' || run)")} AS h FROM each, {CRC_TABLE}),
typed AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
lost AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
keys AS (SELECT word, i, left(word, CAST(i AS INT) - 1) || substr(word, CAST(i AS INT) + 1) AS rest FROM lost),
pairs AS (
  SELECT a.word, b.word AS other FROM keys a JOIN keys b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, rest FROM keys WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM keys WHERE rest IN (SELECT word FROM words)),
best AS (
  SELECT p.word, w.n, other, o.n AS other_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, encode(other)) AS place
  FROM pairs p JOIN words w ON w.word = p.word JOIN words o ON o.word = p.other),
forms AS (SELECT word, other AS form, other_n AS form_n FROM best WHERE place = 1 AND other_n >= 10 * n),
ways(word, stop) AS (SELECT word, word FROM words UNION SELECT ways.word, form FROM ways JOIN forms ON forms.word = ways.stop),
roots AS (SELECT word, stop AS root FROM ways WHERE stop NOT IN (SELECT word FROM forms))
SELECT w.word, form, root, w.n, coalesce(b.n_near, 0) AS n_near, form_n
FROM words w JOIN roots r ON r.word = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN best b ON b.word = w.word AND b.place = 1""",
    "op13_near_vectors": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
              THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings),
l AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.95),
reach(a, b) AS (SELECT r, r FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
low AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, true) AS kept
FROM v JOIN low ON v.r = low.a LEFT JOIN n ON v.r = n.a""",
}
