"""Registered queries of phrase mining, secret scans and the source audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.registry import table

from .divergence import divergence
from .phrases import collocations
from .secrets import scan_secrets


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), max_words=3, min_count=10, top=2000)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        "spans", "n_novel")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


OP11_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+') AS w FROM documents),
g AS (SELECT lang, unnest(w) AS x, unnest(w[2:]) AS y, unnest(w[3:]) AS z FROM t),
m AS (
  SELECT lang, x, CASE WHEN NOT regexp_full_match(y, '[.,;:!?\x0A-\x0D]') THEN y END AS y,
         CASE WHEN NOT regexp_full_match(z, '[.,;:!?\x0A-\x0D]') THEN z END AS z
  FROM g WHERE NOT regexp_full_match(x, '[.,;:!?\x0A-\x0D]')),
f1 AS (SELECT lang, x, count(*)::HUGEINT AS f FROM m GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*)::HUGEINT AS f FROM m WHERE y IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, x, y, z, count(*)::HUGEINT AS f FROM m
       WHERE y IS NOT NULL AND z IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
c3 AS (
  SELECT f3.*, p.f AS l1, q.f AS r1, u.f AS l2, v.f AS r2,
         (1000000 * f3.f * f3.f) // (p.f * q.f) AS s1, (1000000 * f3.f * f3.f) // (u.f * v.f) AS s2
  FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.x = f3.x
  JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
  JOIN f2 u ON u.lang = f3.lang AND u.x = f3.x AND u.y = f3.y
  JOIN f1 v ON v.lang = f3.lang AND v.x = f3.z
  WHERE f3.f >= 10),
held AS (
  SELECT lang, x, y, max(f) AS f FROM (
    SELECT lang, x, y, f FROM c3 UNION ALL SELECT lang, y, z, f FROM c3) GROUP BY ALL),
c AS (
  SELECT lang, x || ' ' || y || ' ' || z AS phrase, f AS a,
         CASE WHEN s1 <= s2 THEN l1 ELSE l2 END AS l, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END AS r,
         least(s1, s2) AS score
  FROM c3
  UNION ALL
  SELECT f2.lang, f2.x || ' ' || f2.y, f2.f, p.f, q.f, (1000000 * f2.f * f2.f) // (p.f * q.f)
  FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.x = f2.x JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y
  LEFT JOIN held ON held.lang = f2.lang AND held.x = f2.x AND held.y = f2.y
  WHERE f2.f >= 10 AND (held.f IS NULL OR 100 * held.f < 50 * f2.f)),
k AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n,
       score::BIGINT AS score
FROM k JOIN n USING (lang) WHERE rank <= 2000
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT row, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS m FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(m) AS total FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
x AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v.v,
         1 + (1000000000::HUGEINT * (k.m + 5)) // (v.total + 5 * v.v) AS q,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY s.lang, s.source) AS total
  FROM s JOIN k ON k.lang = s.lang JOIN v ON v.lang = s.lang
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p FROM x),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
z AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM z WHERE part = 'pair' OR rank <= 50
"""

QUERIES = {f.__name__: f for f in (op11_phrases, op12_secrets, op13_divergence)}
ORACLES = {"op11_phrases": OP11_SQL, "op13_divergence": OP13_SQL}
