"""Registered queries: aggregations (G3 G6 G14 G15 G17 G19 G20 G22-G24, J1 J6
J7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions.text import WS, word_count
from tablekit.operators import aggs as G
from tablekit.operators.joins import broadcast_left_join, run_compare
from tablekit.registry import query, table


@query("min_class_size", sql="""
WITH sizes AS (SELECT lang, source, count(*) AS size FROM documents GROUP BY ALL)
SELECT d.doc_id, d.lang, d.source FROM documents d
JOIN sizes s ON s.lang = d.lang AND s.source = d.source WHERE s.size >= 3
""")
def q_min_class_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of (lang, source) classes with at least 3 rows."""
    kept, _ = G.min_class_size(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"),
                               ["lang", "source"], 3)
    return kept


@query("min_class_size_skipped", sql="""
SELECT lang, source, count(*) AS size FROM documents GROUP BY ALL HAVING count(*) < 3
""")
def q_min_class_size_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 report: the classes left out and their sizes."""
    _, skipped = G.min_class_size(table(spark, sf_dir, "documents"), ["lang", "source"], 3)
    return skipped


@query("weighted_mean_loss", sql="""
SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS weighted_mean,
       round(sum(l_quantity), 2) AS weight
FROM lineitem GROUP BY l_returnflag
""")
def q_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount weighted by quantity (mean loss weighted by batch size)."""
    w = G.weighted_mean(table(spark, sf_dir, "lineitem"), "l_discount", "l_quantity",
                        by=["l_returnflag"])
    return w.select("l_returnflag", F.round("weighted_mean", 6).alias("weighted_mean"),
                    F.round("weight", 2).alias("weight"))


@query("key_dedup", sql="""
WITH raw AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
             UNION ALL
             SELECT l_orderkey, l_linenumber, l_quantity + 1, l_returnflag FROM lineitem
             WHERE l_linestatus = 'O')
SELECT * FROM raw
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_quantity NULLS FIRST, l_returnflag NULLS FIRST) = 1
""")
def q_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of open lines differ in quantity; the survivor is the
    smallest row, whatever the layout."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                  "l_returnflag", "l_linestatus")
    dup = li.filter(F.col("l_linestatus") == "O").withColumn("l_quantity", F.col("l_quantity") + 1)
    raw = li.unionByName(dup).drop("l_linestatus")
    return G.key_dedup(raw, ["l_orderkey", "l_linenumber"])


@query("broadcast_left_join", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name AS zone_name, s.s_nationkey AS zone_nation
FROM lineitem l LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l.l_suppkey
""")
def q_broadcast_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line keeps its row; suppliers without a positive balance
    are not in the lookup, so their lines get NULL zone columns."""
    zones = (table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0)
             .select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("zone_name"),
                     F.col("s_nationkey").alias("zone_nation")))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return broadcast_left_join(li, zones, "l_suppkey")


@query("parity_check", sql="""
WITH t AS (
  SELECT l_quantity - 1 AS distance,
         CASE WHEN l_quantity - 1 > 0 AND h > 0 THEN (l_quantity - 1) / h END AS speed
  FROM (SELECT l.*, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 AS h
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)),
a AS (SELECT * FROM t WHERE speed IS NOT NULL),
b AS (SELECT * FROM a UNION ALL SELECT * FROM a WHERE distance > 25),
sa AS (SELECT count(*) AS n, avg(speed) AS m, sum(distance) AS d FROM a),
sb AS (SELECT count(*) AS n, avg(speed) AS m, sum(distance) AS d FROM b)
SELECT sa.n AS a_rows, sb.n AS b_rows, round(sa.m, 4) AS a_mean_speed, round(sb.m, 4) AS b_mean_speed,
       round(sa.d, 2) AS a_distance_sum, round(sb.d, 2) AS b_distance_sum,
       abs(sa.n - sb.n) AS row_diff, round(abs(sa.n - sb.n) * 100.0 / sa.n, 4) AS row_diff_pct,
       round(abs(sa.m - sb.m) / sa.m, 6) AS rel_speed_diff, abs(sa.m - sb.m) / sa.m < 0.01 AS passed
FROM sa, sb
""")
def q_parity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G15 + J6: two outputs of the speed step, the second with long trips
    counted twice (a dedup defect); rows, means, sums and the 1 % gate."""
    from tablekit.functions.scalars import duration_hours, safe_ratio
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    t = li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.col("l_quantity") - 1).alias("distance"),
        safe_ratio(F.col("l_quantity") - 1, duration_hours("o_orderdate", "l_shipdate")).alias("speed"))
    a = t.filter(F.col("speed").isNotNull())
    b = a.unionByName(a.filter(F.col("distance") > 25))
    p = G.parity_check(a, b, "speed", "distance")
    return p.select(
        "a_rows", "b_rows", F.round("a_mean_speed", 4).alias("a_mean_speed"),
        F.round("b_mean_speed", 4).alias("b_mean_speed"),
        F.round("a_distance_sum", 2).alias("a_distance_sum"),
        F.round("b_distance_sum", 2).alias("b_distance_sum"), "row_diff",
        F.round("row_diff_pct", 4).alias("row_diff_pct"),
        F.round("rel_speed_diff", 6).alias("rel_speed_diff"), "passed")


@query("labelled_counter", sql="""
SELECT event_type, user_id, count(*) AS total FROM events GROUP BY ALL
""")
def q_labelled_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total per label set (requests by source and mode)."""
    return G.labelled_counter(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query("summary_metric", sql=f"""
SELECT lang, CAST(sum(w) AS BIGINT) AS sum, count(w) AS count, round(avg(w), 6) AS mean
FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '')) AS w
      FROM documents)
GROUP BY lang
""")
def q_summary_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and count of observed word counts per language."""
    d = table(spark, sf_dir, "documents").select("lang", word_count("text").alias("w"))
    s = G.summary_metric(d, "w", by=["lang"])
    return s.select("lang", F.col("sum").cast("long").alias("sum"), "count",
                    F.round("mean", 6).alias("mean"))


@query("word_count_stats", sql=f"""
SELECT lang, count(*) AS docs, CAST(sum(w) AS BIGINT) AS words, min(w) AS min_words,
       max(w) AS max_words
FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '')) AS w
      FROM documents)
GROUP BY lang
""")
def q_word_count_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G24 + X7: words per whole text (white-space split) aggregated."""
    d = table(spark, sf_dir, "documents").select("lang", word_count("text").alias("w"))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"),
                                 F.sum("w").cast("long").alias("words"),
                                 F.min("w").cast("long").alias("min_words"),
                                 F.max("w").cast("long").alias("max_words"))


def _hist_sql(bounds: list[float]) -> str:
    parts = [f"SELECT event_type, sum, count, {float(b)} AS le, c{i} AS bucket_count FROM w"
             for i, b in enumerate(bounds)]
    parts.append("SELECT event_type, sum, count, 'Infinity'::DOUBLE, cinf FROM w")
    cnts = ", ".join(f"count(*) FILTER (WHERE value <= {float(b)}) AS c{i}"
                     for i, b in enumerate(bounds))
    return (f"WITH w AS (SELECT event_type, round(sum(value), 4) AS sum, count(value) AS count, "
            f"{cnts}, count(value) AS cinf FROM events GROUP BY event_type)\n"
            + "\nUNION ALL ".join(parts))


@query("histogram_buckets", sql=_hist_sql(G.BATCH_SIZE_BUCKETS))
def q_histogram_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative bucket counts (value <= le, +Inf) per event type."""
    h = G.histogram_buckets(table(spark, sf_dir, "events"), "value", G.BATCH_SIZE_BUCKETS,
                            by=["event_type"])
    return h.withColumn("sum", F.round("sum", 4))


@query("dataset_fingerprint", sql="""
WITH r AS (SELECT concat_ws(chr(1), coalesce(CAST(doc_id AS VARCHAR), chr(0)), coalesce(text, chr(0)),
                            coalesce(lang, chr(0)), coalesce(source, chr(0)),
                            coalesce(CAST(n_chars AS VARCHAR), chr(0))) AS t
           FROM documents)
SELECT 'documents' AS dataset,
       CAST(sum(('0x' || substr(md5(t), 1, 15))::HUGEINT) AS VARCHAR) AS content_hash,
       count(*) AS rows, CAST(sum(length(t)) AS BIGINT) AS text_bytes, 5 AS columns
FROM r
""")
def q_dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-free content hash, rows and bytes of ``documents``."""
    return G.dataset_fingerprint(table(spark, sf_dir, "documents"), "documents")


@query("class_weights", sql="""
SELECT label, count(*) AS count, round(1.0 / count(*), 8) AS inv_weight,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 8) AS balanced_weight
FROM embeddings GROUP BY label
""")
def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampler weight 1/count and balanced weight n/(k*count)."""
    w = G.class_weights(table(spark, sf_dir, "embeddings"), "label")
    return w.select("label", "count", F.round("inv_weight", 8).alias("inv_weight"),
                    F.round("balanced_weight", 8).alias("balanced_weight"))


@query("run_compare_join", sql="""
WITH s AS (SELECT event_type AS run, strftime(ts, '%Y-%m-%d') AS stage, sum(value) AS sec
           FROM events GROUP BY ALL),
b AS (SELECT stage, sec AS base_sec FROM s WHERE run = 'view')
SELECT s.stage, s.run, round(s.sec, 4) AS sec, round(b.base_sec, 4) AS base_sec,
       round(s.sec / b.base_sec, 6) AS ratio, round(b.base_sec / s.sec, 6) AS speedup
FROM s JOIN b ON b.stage = s.stage
""")
def q_run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily cost per event type ("run") against the 'view' run."""
    ev = table(spark, sf_dir, "events")
    s = ev.groupBy(F.col("event_type").alias("run"), F.date_format("ts", "yyyy-MM-dd").alias("stage")).agg(
        F.sum("value").alias("sec"))
    r = run_compare(s, "view")
    return r.select("stage", "run", F.round("sec", 4).alias("sec"),
                    F.round("base_sec", 4).alias("base_sec"), F.round("ratio", 6).alias("ratio"),
                    F.round("speedup", 6).alias("speedup"))
