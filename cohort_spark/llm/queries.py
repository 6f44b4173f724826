"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_spark.llm.bpe import bpe_encode
from cohort_spark.llm.conversation_repair import damage_and_repair
from cohort_spark.llm.embedding_dedup import embedding_dedup
from cohort_spark.llm.hard_negatives import hard_negatives
from cohort_spark.llm.html_extract import html_extract
from cohort_spark.llm.license_scan import license_scan, license_sql
from cohort_spark.llm.minhash_dedup import minhash_dedup
from cohort_spark.llm.pii import pii_scan
from cohort_spark.llm.quality_rules import quality_rules
from cohort_spark.llm.secret_scan import secret_scan
from cohort_spark.llm.source_mix import source_mix
from cohort_spark.llm.toxicity import toxicity
from cohort_spark.llm.url_filter import url_filter
from cohort_spark.plans.registry import tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@_query("op1_license_scan", license_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(tb(spark, sf_dir, "documents"))


@_query("op2_source_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(tb(spark, sf_dir, "documents"))


@_query("op3_embedding_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
       m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings AS e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) AS m ON m.a = e.vec_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(tb(spark, sf_dir, "embeddings"))


@_query("op4_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_encode(tb(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, digests=True)


@_query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(tb(spark, sf_dir, "documents")).drop("n_inferred")


@_query("op6_html_extract")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(tb(spark, sf_dir, "pages"))


@_query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(tb(spark, sf_dir, "documents"))


@_query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(tb(spark, sf_dir, "documents"), tb(spark, sf_dir, "labels"))


@_query("op9_minhash_dedup", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END)) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach AS r JOIN both_ways AS l ON r.b = l.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents AS d LEFT JOIN sizes AS s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) AS m ON m.a = d.doc_id
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(tb(spark, sf_dir, "documents"))


@_query("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(tb(spark, sf_dir, "pages"))


@_query("op11_conversation_repair", r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM src, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copies(c) WHERE kind <> 0
), flagged AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS rn
  FROM damaged
), numbered AS (
  SELECT conv_id, turn, rn, role, text, CASE WHEN bare = '' THEN 1 WHEN rn > min(rn) OVER (PARTITION BY conv_id, role, text) THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS ini,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY rn), 1) || left(role, 1) AS pair, rn > 1 AS later FROM flagged
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (later AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n
  FROM numbered GROUP BY conv_id
), inserts(before, spot, price, letters, lines) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 2, 'I', chr(10) || 'user:'), (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, 0, '', ''), (1, 2, 2, 'I', chr(10) || 'user:'), (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, '', ''), (2, 3, 2, 'I', chr(10) || 'assistant:'), (3, 3, 0, '', ''), (3, 2, 2, 'I', chr(10) || 'user:')
), walk(conv_id, rn, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := '', state := 0) FROM counts
  UNION ALL
  SELECT conv_id, rn, min(way) FROM (
    SELECT w.conv_id, r.rn, struct_pack(
        cost := CAST(w.best.cost + i.price + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN e.edit <> 'D' AND r.fault = 3 THEN 1 ELSE 0 END AS BIGINT),
        audit := w.best.audit || i.letters || e.edit,
        lines := w.best.lines || i.lines || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
                 ELSE chr(10) || CASE WHEN i.spot = 2 THEN 'assistant:' ELSE 'user:' END || r.text END,
        state := CASE e.edit WHEN 'D' THEN i.spot WHEN 'K' THEN r.ini ELSE CASE WHEN i.spot = 2 THEN 3 ELSE 2 END END) AS way
    FROM walk AS w JOIN numbered AS r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.rn = w.rn + 1
    JOIN inserts AS i ON i.before = w.best.state
    JOIN (VALUES ('D'), ('K'), ('R')) AS e(edit)
      ON e.edit = 'D' OR r.fault NOT IN (1, 2) AND (e.edit = 'R' OR (r.ini = 1 AND i.spot = 0) OR (r.ini = 2 AND i.spot <> 2) OR (r.ini = 3 AND i.spot = 2))
  ) AS ways GROUP BY conv_id, rn, way.state
), ends AS (
  SELECT w.conv_id, min(struct_pack(cost := w.best.cost + t.price, audit := w.best.audit || t.letters, lines := w.best.lines || t.lines)) AS b
  FROM walk AS w JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.rn
  JOIN inserts AS t ON t.before = w.best.state AND (t.spot = 3 OR t.before = 0 AND t.spot = 0) GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, coalesce(e.b.cost, 0) AS cost, coalesce(e.b.audit, '') AS audit, sha256(coalesce(substr(e.b.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends AS e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_and_repair(tb(spark, sf_dir, "conversations"))


@_query("op12_hard_negatives", """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, a.e AS anchor, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON len(a.e) = len(b.e) AND (a.vec_id IS DISTINCT FROM b.vec_id OR a.e <> b.e) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, anchor, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor ORDER BY score DESC, id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.anchor, p.positive_id ORDER BY s.score DESC, s.id NULLS LAST) AS INTEGER) AS "rank", s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives AS p JOIN scores AS s ON s.anchor_id = p.anchor_id AND s.anchor = p.anchor AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY "rank" <= 5
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(tb(spark, sf_dir, "embeddings").withColumn("label", noisy))


@_query("op13_pii")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan(tb(spark, sf_dir, "documents")).drop("n_added")
