"""Registered queries: exact ranks, splits and sampling (W1-W3, W11, M1, J2,
J8, G4, K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators import splits as SP
from tablekit.operators.aggs import split_share
from tablekit.operators.joins import label_lookup
from tablekit.registry import query, scratch_dir_for, table
from tablekit.sources.sinks import sink_split_partitions

_H = "md5('42|' || CAST({k} AS VARCHAR))"


@query("position_slice", sql="""
SELECT o_orderkey, o_orderdate FROM (
  SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
WHERE r > 7000 AND r <= 8000""")
def q_position_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows [7000, 8000) in date order (the 'next day' slice)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return SP.position_slice(o, ["o_orderdate", "o_orderkey"], 7000, 8000)


@query("fraction_slice", sql="""
SELECT o_orderkey, o_orderdate FROM (
  SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r,
         count(*) OVER () AS n FROM orders)
WHERE r > floor(n * 0.7) AND r <= floor(n * 0.8)""")
def q_fraction_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 in shares: the 70-80 % band in date order, the same band as rows
    7000-8000 of 10,000, growing with the table."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return SP.fraction_slice(o, ["o_orderdate", "o_orderkey"], 0.7, 0.8)


@query("label_encode", sql="""
SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_code
FROM part""")
def q_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct brands to 0..k-1."""
    enc, _ = SP.label_encode(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand")
    return enc.select("p_partkey", "p_brand", "p_brand_code")


@query("label_lookup", sql="""
WITH m AS (SELECT source AS label, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label_idx
           FROM (SELECT DISTINCT source FROM documents))
SELECT d.doc_id, d.source AS label, m.label_idx FROM documents d LEFT JOIN m ON m.label = d.source""")
def q_label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label text to code through the (broadcast) label map."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("label"))
    _, m = SP.label_encode(docs.select("label"), "label", name="label_idx")
    return label_lookup(docs, m)


_STRAT = f"""s AS (
  SELECT doc_id, lang,
         row_number() OVER (PARTITION BY lang ORDER BY {_H.format(k='doc_id')}, doc_id) AS r,
         count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
t AS (SELECT *, greatest(1, CAST(round(n * 0.1) AS BIGINT)) AS nt FROM s),
v AS (SELECT *, greatest(1, CAST(round((n - nt) * 0.2) AS BIGINT)) AS nv FROM t),
sp AS (SELECT doc_id, lang, CASE WHEN r <= nt THEN 'test' WHEN r <= nt + nv THEN 'val'
                                 ELSE 'train' END AS split FROM v)"""


def _stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SP.stratified_split(docs, "lang", "doc_id", 0.1, 0.2, seed=42)


@query("stratified_split", sql=f"WITH {_STRAT} SELECT * FROM sp")
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-language 10 % test, 20 % of the rest validation, seeded."""
    return _stratified(spark, sf_dir).select("doc_id", "lang", "split")


@query("split_share", sql=f"""WITH {_STRAT}
SELECT split, count(*) AS rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct
FROM sp GROUP BY split""")
def q_split_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and percent per split."""
    return split_share(_stratified(spark, sf_dir), "split")


@query("sink_split_partitions", sql=f"""WITH {_STRAT}
SELECT split, lang, count(*) AS rows FROM sp GROUP BY ALL""")
def q_sink_split_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: all splits written in one job, one folder per split; read back."""
    path = scratch_dir_for(spark, "splits")
    sink_split_partitions(_stratified(spark, sf_dir), path, "split")
    back = spark.read.parquet(path)
    return back.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("rows"))


@query("exact_random_split", sql=f"""
SELECT p_partkey, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT p_partkey, row_number() OVER (ORDER BY {_H.format(k='p_partkey')}, p_partkey) AS r,
         count(*) OVER () AS n FROM part)""")
def q_exact_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: seeded 80/20 split of exact size."""
    return SP.exact_random_split(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey",
                                 0.2, 42).select("p_partkey", "split")


@query("batch_ids", sql=f"""
SELECT vec_id, (row_number() OVER (ORDER BY {_H.format(k='vec_id')}, vec_id) - 1) // 64 AS batch_id
FROM embeddings""")
def q_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffled batches of 64 rows (seeded order)."""
    e = SP.seeded_shuffle(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", 42, "_h")
    return SP.batch_ids(e, ["_h", "vec_id"], 64).select("vec_id", "batch_id")


def _u(seed: str, salt: str, key: str) -> str:
    return (f"CAST(('0x' || substr(md5('{seed}|{salt}|' || CAST({key} AS VARCHAR)), 1, 13))::BIGINT "
            f"AS DOUBLE) / 4503599627370496.0")


@query("weighted_resample", sql=f"""
WITH codes AS (SELECT label, row_number() OVER (ORDER BY label) AS c FROM (SELECT DISTINCT label FROM embeddings)),
k AS (SELECT count(*) AS k FROM codes),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
draws AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id FROM embeddings),
d1 AS (SELECT id, CAST(floor({_u('42', 'class', 'id')} * k.k) + 1 AS BIGINT) AS c FROM draws, k),
d2 AS (SELECT d1.id, codes.label, CAST(floor({_u('42', 'row', 'd1.id')} * sizes.n) + 1 AS BIGINT) AS rn
       FROM d1 JOIN codes ON codes.c = d1.c JOIN sizes ON sizes.label = codes.label),
rows AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings)
SELECT d2.id AS draw_id, d2.label, rows.vec_id FROM d2 JOIN rows ON rows.label = d2.label AND rows.rn = d2.rn""")
def q_weighted_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws with replacement, classes even: class uniform, row uniform
    inside the class, both from md5; draws join rows on (class, row no.)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return SP.weighted_resample(e, "label", "vec_id", seed=42).select("draw_id", "label", "vec_id")
