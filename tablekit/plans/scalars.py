"""Registered queries: scalar, array and vectorised-UDF functions (X3, X8-X10,
X13-X18, X20, X23, T3, M13, S7, D2-D4, D6)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions import arrays as A
from tablekit.functions import scalars as X
from tablekit.functions.text import base64_text, percent_encode, status_subject
from tablekit.operators.udfs import batch_local_dedup, feature_udf, map_batches, skip_bad_rows
from tablekit.registry import query, table
from tablekit.sources.files import parse_tensor

_LOGITS = "scores"


@query("round_digits", sql="""
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * (1 - l_discount) * 100.0, 0) / 100.0 AS net,
       round_even(l_quantity / 7 * 10000.0, 0) / 10000.0 AS q7
FROM lineitem""")
def q_round_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round to 2 and 4 digits by the numpy rule (the 4-decimal products
    here hit exact ties, where rounding rules differ)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.round_digits(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net"),
                     X.round_digits(F.col("l_quantity") / 7, 4).alias("q7"))


@query("percent_encode", sql="""
SELECT doc_id, 'https://image.example/prompt/' || replace(url_encode(text), '%2F', '/') AS url
FROM documents""")
def q_percent_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole text encoded as a URL path value."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat(F.lit("https://image.example/prompt/"),
                                       percent_encode("text")).alias("url"))


@query("base64_text", sql="SELECT conv_id, turn, to_base64(encode(text)) AS b64 FROM conversations")
def q_base64_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 bytes of each whole turn as one-line base64 text."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", base64_text("text").alias("b64"))


@query("top_1", sql="""
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS top_class
FROM embeddings""")
def q_top_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of the largest element per row."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", A.argmax("embedding").alias("top_class"))


@query("softmax_confidence", sql=f"""
SELECT vec_id, CAST(list_position({_LOGITS}, list_max({_LOGITS})) - 1 AS INTEGER) AS predicted,
       round(1.0 / list_sum(list_transform({_LOGITS},
             lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max({_LOGITS}) AS DOUBLE)))), 6) AS confidence
FROM (SELECT vec_id, list(s ORDER BY j) AS scores FROM (
        SELECT vec_id, (pos - 1) % 10 AS j, sum(CAST(v AS DOUBLE)) AS s
        FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos
              FROM embeddings) GROUP BY ALL) GROUP BY vec_id)""")
def q_softmax_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten scores off the whole vector as logits: predicted class and its
    probability."""
    e = table(spark, sf_dir, "embeddings")
    s = A.softmax_confidence(A.class_logits("embedding", 10))
    return e.select("vec_id", s.getField("predicted").alias("predicted"),
                    F.round(s.getField("confidence"), 6).alias("confidence"))


_GREY = "list_transform(embedding, lambda x: least(255.0, greatest(0.0, (CAST(x AS DOUBLE) + 2.0) * 63.75)))"


def _grey(col="embedding"):
    return F.transform(col, lambda x: F.least(F.lit(255.0), F.greatest(
        F.lit(0.0), (x.cast("double") + 2.0) * 63.75)))


@query("normalize_array", sql=f"""
WITH g AS (SELECT vec_id, {_GREY} AS a FROM embeddings),
m AS (SELECT vec_id, a, list_sum(a) / len(a) > 127.0 AS inv FROM g)
SELECT vec_id, list_transform(a, lambda x: round(((CASE WHEN inv THEN 255.0 - x ELSE x END) / 255.0
                                                  - 0.1307) / 0.3081, 4)) AS normalized
FROM m""")
def q_normalize_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings mapped to grey values 0..255, then the image
    normalisation (inversion for light backgrounds)."""
    e = table(spark, sf_dir, "embeddings")
    n = A.normalize_array(_grey())
    return e.select("vec_id", F.transform(n, lambda x: F.round(x, 4)).alias("normalized"))


@query("denormalize_clip", sql="""
SELECT vec_id, list_transform(embedding, lambda x: CAST(trunc(least(255.0, greatest(0.0,
       (CAST(x AS DOUBLE) * 0.3081 + 0.1307) * 255.0))) AS INTEGER)) AS pixels
FROM embeddings""")
def q_denormalize_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised values back to clipped 0..255 integers."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", A.denormalize_clip("embedding").alias("pixels"))


@query("reshape_array", sql="""
SELECT vec_id, CASE WHEN len(embedding) = 64 THEN
         list_transform(range(8), lambda i: list_slice(embedding, i * 8 + 1, i * 8 + 8)) END AS matrix
FROM embeddings""")
def q_reshape_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 values to an 8 x 8 matrix; NULL for any other length."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", A.reshape_array("embedding", 8, 8).alias("matrix"))


@query("scan_json_tensor", sql="""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total,
       len(embedding) AS size FROM embeddings""")
def q_scan_json_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as {"inputs": [[[[...]]]]} JSON of shape [1, 1, 1, n],
    parsed back to nested arrays; total and size of the flattened tensor."""
    e = table(spark, sf_dir, "embeddings")
    doc = F.to_json(F.struct(F.array(F.array(F.array(
        F.transform("embedding", lambda x: x.cast("double"))))).alias("inputs")))
    t = parse_tensor(doc, 4)
    flat = F.flatten(F.flatten(F.flatten(t)))
    return e.select("vec_id", F.round(A.array_sum(flat), 4).alias("total"),
                    F.size(flat).cast("long").alias("size"))


@query("signature_check", sql="""
SELECT count(*) AS rows, count(*) FILTER (WHERE embedding IS NULL OR len(embedding) <> 64) AS bad_shape,
       true AS schema_ok FROM embeddings""")
def q_signature_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column presence / type contract plus one pass for bad shapes."""
    from tablekit.operators.mlops import signature_check
    return signature_check(table(spark, sf_dir, "embeddings"),
                           {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
                           {"embedding": 64})


@query("value_map", sql="""
SELECT doc_id, CASE quality WHEN 0 THEN 'DOWN' WHEN 1 THEN 'UP' END AS state FROM labels""")
def q_value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 -> DOWN, 1 -> UP."""
    lab = table(spark, sf_dir, "labels")
    return lab.select("doc_id", X.value_map("quality", {0: "DOWN", 1: "UP"}).alias("state"))


@query("threshold_band", sql="""
SELECT event_id, CASE WHEN value >= 85 THEN 'red' WHEN value >= 70 THEN 'yellow'
                      WHEN value IS NOT NULL THEN 'green' END AS band FROM events""")
def q_threshold_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green from 0, yellow from 70, red from 85 (lower bound inclusive)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", X.threshold_band("value", [(0, "green"), (70, "yellow"),
                                                            (85, "red")]).alias("band"))


@query("format_text", sql="""
SELECT event_id, '[' || upper(event_type) || '] ' || CAST(user_id AS VARCHAR) AS subject,
       printf('%.2f', value) AS shown FROM events""")
def q_format_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X20: '[STATUS] name' subject and a formatted number."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", status_subject("event_type", F.col("user_id").cast("string"))
                     .alias("subject"), F.format_string("%.2f", "value").alias("shown"))


@query("elapsed", sql="""
SELECT event_id, (epoch_us(nts) - epoch_us(ts)) / 1e6 AS elapsed_s FROM (
  SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts FROM events)
WHERE nts IS NOT NULL""")
def q_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds from each event to the user's next one."""
    from tablekit.operators.splits import next_row
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    n = next_row(ev, ["ts", "event_id"], ["user_id"], ["ts"])
    return n.filter(F.col("next_ts").isNotNull()).select(
        "event_id", X.duration_seconds("ts", "next_ts").alias("elapsed_s"))


# ------------------------------------------------------------------ UDF surface
def _net_batch(b: pd.DataFrame) -> pd.DataFrame:
    b = b[b["l_discount"] > 0]
    return b.assign(net=b["l_extendedprice"] * (1 - b["l_discount"]))[
        ["l_orderkey", "l_linenumber", "net"]]


@query("map_batches", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net
FROM lineitem WHERE l_discount > 0""")
def q_map_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas batch function that drops rows and adds a column."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                                  "l_discount")
    return map_batches(li, _net_batch, "l_orderkey long, l_linenumber int, net double")


def _k_of(s: str) -> float:
    return float(json.loads(s)["k"])


@query("skip_bad_rows", sql=r"""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                      ELSE CAST(regexp_extract(props, '"k":\s*([0-9]+)', 1) AS DOUBLE) END AS value_out,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status
FROM events""")
def q_skip_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A per-value parser over batches; malformed payloads (error
    events carry a broken JSON text) become status 'failed', the job goes on."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.concat("props", F.lit("}")))
        .otherwise(F.col("props")).alias("props"))
    return skip_bad_rows(ev, "props", _k_of).select("event_id", "value_out", "status")


@query("batch_local_dedup")
def q_batch_local_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: dedup inside each batch only (a defect, kept for comparison):
    rows left against the global dedup count."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    doubled = li.unionByName(li)
    local = batch_local_dedup(doubled, ["l_orderkey", "l_linenumber"])
    g = doubled.dropDuplicates(["l_orderkey", "l_linenumber"])
    return (local.agg(F.count(F.lit(1)).alias("batch_local_rows"))
                 .crossJoin(g.agg(F.count(F.lit(1)).alias("global_rows"))))


_HOG_SQL = """
WITH p AS (  -- pixels with their neighbours; the border has no difference
  SELECT vec_id, i // 8 AS y, i % 8 AS x, embedding AS e, i
  FROM embeddings, (SELECT unnest(range(0, 64)) AS i) WHERE len(embedding) = 64),
g AS (
  SELECT vec_id, y // 2 AS cy, x // 2 AS cx,
         CASE WHEN x BETWEEN 1 AND 6 THEN e[i + 2]::DOUBLE - e[i]::DOUBLE ELSE 0.0 END AS gx,
         CASE WHEN y BETWEEN 1 AND 6 THEN e[i + 9]::DOUBLE - e[i - 7]::DOUBLE ELSE 0.0 END AS gy FROM p),
d AS (SELECT *, degrees(atan2(gy, gx)) AS t FROM g),
c AS (
  SELECT vec_id, cy, cx, least(floor((CASE WHEN t < 0 THEN t + 180.0 WHEN t >= 180 THEN t - 180.0 ELSE t END) / 20.0), 8)::INT AS o,
         sum(sqrt(gx * gx + gy * gy)) / 4 AS h FROM d GROUP BY ALL),
b AS (  -- overlapping 2 x 2 blocks of cells
  SELECT v.vec_id, by_, bx, dy, dx, o_ AS o, coalesce(c.h, 0.0) AS h
  FROM (SELECT vec_id FROM embeddings WHERE len(embedding) = 64) v,
       (SELECT unnest(range(0, 3)) AS by_), (SELECT unnest(range(0, 3)) AS bx),
       (SELECT unnest(range(0, 2)) AS dy), (SELECT unnest(range(0, 2)) AS dx),
       (SELECT unnest(range(0, 9)) AS o_) q
  LEFT JOIN c ON c.vec_id = v.vec_id AND c.cy = by_ + dy AND c.cx = bx + dx AND c.o = o_),
n AS (SELECT *, least(h / sqrt(sum(h * h) OVER w + 1e-10), 0.2) AS u FROM b WINDOW w AS (PARTITION BY vec_id, by_, bx)),
f AS (SELECT *, round(u / sqrt(sum(u * u) OVER w + 1e-10), 6) AS z FROM n WINDOW w AS (PARTITION BY vec_id, by_, bx))
SELECT vec_id, by_::INT AS block_row, bx::INT AS block_col, round(sum(z), 6) AS total, round(max(z), 6) AS highest,
       round(sum(z * (18 * dy + 9 * dx + o)), 6) AS moment
FROM f GROUP BY ALL"""


@query("feature_udf", sql=_HOG_SQL)
def q_feature_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 arrays to gradient histograms (cells of 2 x 2 pixels, blocks
    of 2 x 2 cells, 9 bins); one row a block with three measures of its 36
    values."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", feature_udf(8, 9)("embedding").alias("f"))
    b = v.filter("f is not null").select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("b"), "f")
    b = b.select("vec_id", F.expr("cast(b div 3 as int)").alias("block_row"), (F.col("b") % 3).alias("block_col"),
                 F.transform(F.slice("f", F.col("b") * 36 + 1, 36), lambda x: F.round(x, 6)).alias("z"))
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    return b.select("vec_id", "block_row", "block_col", F.round(add(F.col("z")), 6).alias("total"),
                    F.round(F.array_max("z"), 6).alias("highest"),
                    F.round(add(F.transform("z", lambda x, i: x * i)), 6).alias("moment"))


_ = X.iso_time
