"""Registered queries of the operators: thin digests of their results."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.registry import table

from . import more_queries
from .chat import format_chats
from .common import bucket_of
from .decontam import decontaminate
from .langid import fit_languages, identify_language
from .quality import quality
from .sentencepiece import Pieces, encode
from .sharding import LAW, shard
from .simhash import simhash_groups
from .substring import substring_dedup
from .toxicity import fit_toxicity, labelled, score_toxicity
from .urls import judge_urls

#: Path of a SentencePiece model file; by default the installed public one.
MODEL_ENV = "TABLEKIT_PIECE_MODEL"


def piece_model(path: str | None = None) -> Pieces:
    path = path or os.environ.get(MODEL_ENV)
    if not path:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    return Pieces.load(path)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = labelled(docs.filter(bucket_of("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    return (score_toxicity(docs, fit_toxicity(train))
            .select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode(table(spark, sf_dir, "documents"), piece_model())
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = fit_languages(docs.filter(bucket_of("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    return identify_language(docs, models).select(
        "doc_id", (bucket_of("doc_id", 3) == 1).alias("held_out"), F.col("best").alias("lang_pred"), "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), min_words=13).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_simhash, op3_sentencepiece, op4_quality, op5_langid, op6_decontamination,
    op7_sharding, op8_chat, op9_substring, op10_urls)} | more_queries.QUERIES


# ------------------------------------------------------------ SQL twins
OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
pos AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS s FROM pos),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win)
  WHERE c > 1),
cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM rep, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(replace(text, '!', '')) AS n_bangs,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
    coalesce(cov.n, 0) AS n_repeat_words,
    len(list_filter(lines, lambda x: length(x) < 25)) AS n_short,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter,
    len(list_filter(words, lambda x: list_contains(string_split('{stop}', ' '), x))) AS n_stop
  FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed
    AND word_chars / n_words BETWEEN 2.0 AND 12.0
    AND n_symbols / n_words <= 0.1
    AND n_bangs / n_words <= 0.1
    AND n_stop / n_words >= 0.03
    AND n_dup_lines / n_lines <= 0.5
    AND n_short / n_lines <= 0.9
    AND n_letter / n_words >= 0.7 AS kept
FROM b
"""

OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents),
bw AS (
  SELECT item_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM benchmark),
bwin AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, words, least(10, len(words)) AS n,
               unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM bw WHERE len(words) > 0)),
lens AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM dw, lens WHERE len(words) >= n)),
hit AS (SELECT doc_id, dwin.n, i, item_id FROM dwin JOIN bwin ON dwin.n = bwin.n AND dwin.s = bwin.s),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit))
  GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP8_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(coalesce(role, chr(1)) || chr(31) || coalesce(text, chr(1)) || chr(30), ''
               ORDER BY turn, role, text) AS s,
    string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '')
               || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, rendered FROM c
WHERE NOT EXISTS (
  SELECT 1 FROM c o WHERE starts_with(o.s, c.s)
    AND (length(o.s) > length(c.s) OR o.conv_id < c.conv_id))
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) >= 13)),
low AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM (SELECT doc_id, i FROM win JOIN low USING (s) WHERE first < doc_id),
       (SELECT unnest(range(0, 13)) AS k)),
pos AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS p, unnest(words) AS w FROM d WHERE len(words) > 0),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS s
  FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(kept.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def oracles() -> dict[str, str]:
    from .quality import STOP_WORDS
    return {"op4_quality": OP4_SQL.replace("{stop}", " ".join(
        [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)])),
            "op6_decontamination": OP6_SQL, "op8_chat": OP8_SQL, "op9_substring": OP9_SQL,
            **more_queries.ORACLES}
