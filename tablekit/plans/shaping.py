"""Registered queries: sources, sinks, projections, filters, sets, orderings
(S1 S2 S5 S8, K2 K5 K7 K9, P1-P12, F1-F10, U1-U4, T1-T5, G1 G2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.scalars import coerce_numeric, with_status
from tablekit.functions.text import derive_path, url_to_file_name
from tablekit.operators import shape as S
from tablekit.operators.aggs import row_count, value_counts
from tablekit.operators.splits import first_n, sample_rows, seeded_shuffle, sorted_distinct
from tablekit.registry import TABLES, query, scratch_dir_for, table
from tablekit.sources import files as SRC
from tablekit.sources import sinks as K


# ------------------------------------------------------------------ sources
@query("scan_csv", sql="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + K2: write ``nation`` as CSV with header, read back typed."""
    path = scratch_dir_for(spark, "nation_csv")
    K.sink_csv(table(spark, sf_dir, "nation"), path)
    return SRC.scan_csv(spark, path, schema=T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType())]))


@query("sink_csv", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: CSV round trip of ``customer`` (doubles survive as text exactly)."""
    cust = table(spark, sf_dir, "customer")
    path = scratch_dir_for(spark, "customer_csv")
    K.sink_csv(cust, path)
    return SRC.scan_csv(spark, path, schema=cust.schema)


@query("scan_url_list", sql=r"""
SELECT regexp_replace(url, '^\s+|\s+$', '', 'g') AS url FROM pages WHERE url LIKE 'http%'
""")
def q_scan_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs written as a header-less one-field CSV, read back."""
    path = scratch_dir_for(spark, "urls_csv")
    table(spark, sf_dir, "pages").select("url").write.option("header", False).csv(path)
    return SRC.scan_url_list(spark, path)


@query("scan_labelled_tree", sql="""
SELECT source AS label, CAST(sum(coalesce(strlen(text), 0) + 1) AS BIGINT) AS bytes
FROM documents GROUP BY source""")
def q_scan_labelled_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as text files in one folder per source and listed
    with labels from the folder names (paths and lengths, no file bytes read).
    A lost or doubled file shows in the bytes."""
    path = scratch_dir_for(spark, "doc_tree")
    docs = table(spark, sf_dir, "documents")
    docs.select("source", "text").write.partitionBy("source").text(path)
    tree = SRC.scan_labelled_tree(spark, path, suffix_regex=r"(?i)\.txt$")
    return tree.groupBy(F.regexp_replace("label", "^source=", "").alias("label")).agg(
        F.sum("length").alias("bytes"))


@query("scan_json_metrics", sql="""
SELECT s_suppkey AS key, s_name AS name, s_acctbal AS value FROM supplier""")
def q_scan_json_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers written as JSON documents, each an array of at most 100
    records in a file of its own, and read back one row a record."""
    path = scratch_dir_for(spark, "json_documents")
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("value"))
    schema = s.schema
    docs = (s.groupBy(F.expr("key div 100").alias("part"))
            .agg(F.to_json(F.collect_list(F.struct("key", "name", "value"))).alias("doc")))
    docs.select("doc").write.option("maxRecordsPerFile", 1).text(path)
    return SRC.scan_json_documents(spark, path, schema)


@query("ensure_table", sql="SELECT n_nationkey, n_name, 2::BIGINT AS calls FROM nation")
def q_ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the table is created by the first call and left as it is by the
    second, which runs after rows were inserted."""
    path = scratch_dir_for(spark, "ensured")
    name = "ensured_" + path.rsplit("-", 1)[-1]
    schema = "n_nationkey BIGINT, n_name STRING"
    K.ensure_table(spark, name, schema, path)
    (table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")
     .write.insertInto(name))
    K.ensure_table(spark, name, schema, path)
    return spark.table(name).withColumn("calls", F.lit(2).cast("long"))


@query("scan_parquet_dir", sql="SELECT r_regionkey, r_name FROM region")
def q_scan_parquet_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive read of a written output folder."""
    path = scratch_dir_for(spark, "region_dir")
    K.sink_parquet(table(spark, sf_dir, "region"), f"{path}/nested/out")
    return SRC.scan_parquet_dir(spark, path).select("r_regionkey", "r_name")


@query("dataset_manifest", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS version, count(*) AS rows, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS columns FROM {t}" for t in TABLES))
def q_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: one lineage row per driver table (time and free text left out)."""
    parts = []
    for t in TABLES:
        m = K.dataset_manifest(table(spark, sf_dir, t), t, f"{sf_dir}/{t}.parquet",
                               "tablekit", ["loaded"])
        parts.append(m.select("version", "rows", F.col("columns").cast("long").alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# K7: pages fetched over plain http failed in an earlier run and are stored;
# this run has every page, success when https.  First write wins.
@query("insert_or_ignore", sql="""
WITH stored AS (SELECT page_id AS id, url FROM pages WHERE url NOT LIKE 'https%'),
batch AS (SELECT page_id, url, CASE WHEN url LIKE 'https%' THEN 'success' ELSE 'failed' END AS status
          FROM pages),
fresh AS (SELECT * FROM batch WHERE url NOT IN (SELECT url FROM stored))
SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY page_id) AS id,
       page_id, url, status
FROM fresh
""")
def q_insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    stored = pages.filter(~F.col("url").startswith("https")).select(
        F.col("page_id").alias("id"), "url")
    batch = pages.select("page_id", "url", F.when(F.col("url").startswith("https"), "success")
                         .otherwise("failed").alias("status"))
    return K.insert_or_ignore(stored, batch, "url", ["page_id"]).select(
        "id", "page_id", "url", "status")


@query("page_content_sink", sql="""
SELECT '/data/scraped/' || replace(replace(replace(url, 'https://', ''), 'http://', ''), '/', '_')
       || '.html' AS html_path, length(html) AS html_chars
FROM pages
""")
def q_page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 + X4: page text stored as one table keyed by the derived path."""
    path = scratch_dir_for(spark, "page_content")
    K.sink_parquet(K.page_content(table(spark, sf_dir, "pages")), path)
    back = spark.read.parquet(path)
    return back.select("html_path", F.length("html").cast("long").alias("html_chars"))


# ------------------------------------------------------------------ projections
@query("drop_if_present", sql="SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_drop_if_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.drop_if_present(table(spark, sf_dir, "customer"), ["c_name", "c_phone", "UDI"])


@query("keep_columns", sql="SELECT l_orderkey, l_quantity, l_tax FROM lineitem")
def q_keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.keep_columns(table(spark, sf_dir, "lineitem"),
                          ["l_orderkey", "airport_fee", "l_quantity", "l_tax"])


@query("rename_ci", sql="SELECT l_orderkey, l_tax, l_quantity FROM lineitem")
def q_rename_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper- and mixed-case variants back to canonical names."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("L_ORDERKEY"), F.col("l_tax").alias("L_Tax"), "l_quantity")
    return S.rename_ci(li, ["l_orderkey", "l_tax", "l_quantity"])


@query("prefix_rename", sql="""
SELECT s_suppkey AS zone, s_name AS zone_name, s_nationkey AS zone_nationkey,
       s_acctbal AS zone_acctbal FROM supplier
""")
def q_prefix_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier")
    return S.prefix_rename(sup, "", {"s_suppkey": "zone", "s_name": "zone_name",
                                     "s_nationkey": "zone_nationkey", "s_acctbal": "zone_acctbal"})


@query("align_features", sql="""
SELECT p_size, 0 AS air_temperature_k, p_retailprice, 0 AS torque_nm FROM part
""")
def q_align_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: request frame missing two model columns; they come back as 0."""
    df, missing = S.align_features(table(spark, sf_dir, "part"),
                                   ["p_size", "air_temperature_k", "p_retailprice", "torque_nm"])
    assert missing == ["air_temperature_k", "torque_nm"]
    return df


@query("numeric_map", sql="""
SELECT l_orderkey, l_partkey + 1 AS l_partkey, l_suppkey + 1 AS l_suppkey,
       l_linenumber + 1 AS l_linenumber, l_quantity + 1 AS l_quantity,
       l_extendedprice + 1 AS l_extendedprice, l_discount + 1 AS l_discount, l_tax + 1 AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem
""")
def q_numeric_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.numeric_map(table(spark, sf_dir, "lineitem"), lambda c: c + 1, exclude=["l_orderkey"])


@query("drift_inject", sql="""
SELECT p_partkey, p_size + 1 AS p_size, round(p_retailprice * 1.01, 6) AS p_retailprice, p_brand
FROM part
""")
def q_drift_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 shift / scale part (noise is checked by its mean and sd in tests)."""
    d = S.drift_inject(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice",
                                                           "p_brand"),
                       key="p_partkey", shift={"p_size": 1}, scale={"p_retailprice": 1.01}, sd=0)
    return d.withColumn("p_retailprice", F.round("p_retailprice", 6))


@query("fill_request_defaults", sql="""
SELECT doc_id, coalesce(CASE WHEN lang <> 'en' THEN lang END, 'es') AS target_lang,
       coalesce(CASE WHEN lang <> 'fr' THEN lang END, 'en') AS speech_lang
FROM documents
""")
def q_fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose language field is unset get 'es' (translation) and
    'en' (speech).  Unset = the document's language equals the source one."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("target_lang"),
        F.when(F.col("lang") != "fr", F.col("lang")).alias("speech_lang"))
    return S.fill_defaults(d, {"target_lang": "es", "speech_lang": "en"})


@query("coerce_numeric", sql=r"""
SELECT event_id, TRY_CAST(regexp_extract(props, ':\s*([^}]*)', 1) AS DOUBLE) AS k,
       TRY_CAST(props AS DOUBLE) AS whole
FROM events
""")
def q_coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: text to number, bad text to NULL (the whole JSON text is bad)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id",
                     coerce_numeric(F.regexp_extract("props", r":\s*([^}]*)", 1)).alias("k"),
                     coerce_numeric("props").alias("whole"))


@query("error_as_value", sql=r"""
SELECT event_id, TRY_CAST(regexp_extract(props, '"k":\s*([0-9]+)', 1) AS DOUBLE) AS value,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN event_type = 'error' THEN 'cannot parse: ' || props END AS error
FROM (SELECT event_id, event_type,
             CASE WHEN event_type = 'error' THEN replace(props, '"k": ', '"k": x') ELSE props END AS props
      FROM events)
""")
def q_error_as_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error payloads carry text where a number belongs; the failure is
    a value (status, error) instead of a failed job."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error",
                           F.replace("props", F.lit('"k": '), F.lit('"k": x')))
        .otherwise(F.col("props")).alias("props"))
    v = F.regexp_extract("props", r'"k":\s*([0-9]+)', 1).try_cast("double")
    failed = F.regexp_extract("props", r'"k":\s*([0-9]+)', 1) == ""
    return ev.select("event_id", v.alias("value"),
                     F.when(failed, "failed").otherwise("success").alias("status"),
                     F.when(failed, F.concat(F.lit("cannot parse: "), F.col("props"))).alias("error"))


@query("derive_path", sql="""
SELECT page_id, '/data/split/' || CASE WHEN url LIKE 'https%' THEN 'secure' ELSE 'plain' END || '/'
       || split_part(url, '/', len(string_split(url, '/'))) AS path
FROM pages
""")
def q_derive_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + X12: base folder / label / file name of the source path."""
    p = table(spark, sf_dir, "pages")
    label = F.when(F.col("url").startswith("https"), "secure").otherwise("plain")
    return p.select("page_id", derive_path("/data/split", label, F.col("url")).alias("path"))


# ------------------------------------------------------------------ filters
@query("dropna_subset", sql="""
SELECT l_orderkey, l_linenumber, passengers, discount FROM (
  SELECT l_orderkey, l_linenumber, NULLIF(l_linenumber, 7) AS passengers,
         NULLIF(l_discount, 0.0) AS discount FROM lineitem)
WHERE passengers IS NOT NULL AND discount IS NOT NULL
""")
def q_dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_linenumber", F.lit(7)).alias("passengers"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"))
    return S.dropna_subset(li, ["passengers", "discount"])


@query("positive_filter", sql="""
SELECT l_orderkey, l_linenumber, l_quantity - 1 AS distance, l_discount
FROM lineitem WHERE l_quantity - 1 > 0 AND l_discount > 0
""")
def q_positive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") - 1).alias("distance"), "l_discount")
    return S.positive_filter(li, ["distance", "l_discount"])


@query("extension_filter", sql=r"""
SELECT page_id, url FROM pages
WHERE (lower(regexp_replace(url, '[?#].*$', '')) LIKE '%.jpg'
    OR lower(regexp_replace(url, '[?#].*$', '')) LIKE '%.jpeg'
    OR lower(regexp_replace(url, '[?#].*$', '')) LIKE '%.png'
    OR lower(regexp_replace(url, '[?#].*$', '')) LIKE '%.html')
  AND NOT starts_with(url, '__MACOSX')
""")
def q_extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + X5: names (URL paths without query) ending in a kept extension,
    any case; .html added so that the driver's pages have matches."""
    p = table(spark, sf_dir, "pages").withColumn(
        "_name", F.regexp_replace("url", r"[?#].*$", ""))
    return S.extension_filter(p, "_name", (".jpg", ".jpeg", ".png", ".html")).select("page_id", "url")


@query("validate_nonempty", sql=r"""
SELECT conv_id, turn, body, valid, reason FROM (
  SELECT conv_id, turn, body,
         NOT (body IS NULL OR body = '' OR regexp_replace(body, '\s', '', 'g') = '') AS valid,
         CASE WHEN body IS NULL THEN 'missing'
              WHEN body = '' OR regexp_replace(body, '\s', '', 'g') = '' THEN 'empty' END AS reason
  FROM (SELECT conv_id, turn, text AS body FROM conversations))
""")
def q_validate_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 (strict): the whole text of each turn is the request; missing and
    blank ones go to quarantine."""
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("body"))
    valid, bad = S.validate_nonempty(c, "body", strict=True)
    return (valid.withColumn("valid", F.lit(True)).withColumn("reason", F.lit(None).cast("string"))
            .unionByName(bad.withColumn("valid", F.lit(False))))


@query("expectations", sql="""
SELECT * FROM (VALUES
  ('quality_binary', (SELECT count(*) FROM labels WHERE quality IS NULL OR quality NOT IN (0, 1)))
 ,('toxic_binary', (SELECT count(*) FROM labels WHERE toxic IS NULL OR toxic NOT IN (0, 1)))
 ,('doc_present', (SELECT count(*) FROM labels WHERE doc_id IS NULL))
 ,('share_in_unit', (SELECT count(*) FROM labels WHERE NOT (doc_id / 1000.0 BETWEEN 0 AND 1)))
) t(rule, failed)
""")
def q_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one pass, one count of breaking rows per rule."""
    lab = table(spark, sf_dir, "labels")
    rules = {"quality_binary": F.col("quality").isin(0, 1),
             "toxic_binary": F.col("toxic").isin(0, 1),
             "doc_present": F.col("doc_id").isNotNull(),
             "share_in_unit": (F.col("doc_id") / 1000.0).between(0, 1)}
    return S.expectations(lab, rules).select("rule", "failed")


@query("time_range_filter", sql="""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '2024-01-15 12:00:00'
""")
def q_time_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: the last hour before a stated reference time."""
    import datetime as dt
    ev = table(spark, sf_dir, "events")
    from tablekit.operators.series import ntz_literal
    ref = ntz_literal(dt.datetime(2024, 1, 15, 12, 0, 0))
    return S.time_range_filter(ev, "ts", ref, 3600).select("event_id", "ts", "user_id", "event_type")


# Per-metric thresholds of the alert rules, mapped to event
# types (error rate 0.05 -> value > 5 ..., see the series plan).
def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("error", "HighErrorRate", ">", 300.0), ("purchase", "SlowInference", ">", 350.0),
         ("view", "TooManyActiveRequests", ">", 330.0), ("click", "HighCPUUsage", ">", 480.0),
         ("signup", "AppDown", "==", 0.0)],
        "event_type string, rule string, op string, limit double")


_RULES_SQL = """(VALUES ('error', 'HighErrorRate', '>', 300.0), ('purchase', 'SlowInference', '>', 350.0),
  ('view', 'TooManyActiveRequests', '>', 330.0), ('click', 'HighCPUUsage', '>', 480.0),
  ('signup', 'AppDown', '==', 0.0)) r(event_type, rule, op, "limit")"""


@query("threshold_rule", sql=f"""
SELECT e.event_id, e.event_type, e.value, r.rule FROM events e JOIN {_RULES_SQL}
  ON e.event_type = r.event_type
WHERE (r.op = '>' AND e.value > r."limit") OR (r.op = '==' AND e.value = r."limit")
""")
def q_threshold_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """samples breaking their metric's rule (rule table broadcast)."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return S.threshold_rule(ev, rule_table(spark), metric="event_type").select(
        "event_id", "event_type", "value", "rule")


@query("label_match", sql="""
SELECT event_id, user_id, value FROM events WHERE event_type = 'error'
""")
def q_label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """selector {event_type="error"} on a label map."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value",
        F.create_map(F.lit("event_type"), F.col("event_type"),
                     F.lit("instance"), F.col("user_id").cast("string")).alias("labels"))
    return S.label_match(ev, "labels", event_type="error").select("event_id", "user_id", "value")


# ------------------------------------------------------------------ sets / order
@query("strict_diff", sql="""
WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders),
b AS (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderpriority = '1-URGENT' THEN round(o_totalprice) ELSE o_totalprice END AS o_totalprice
      FROM orders WHERE o_orderstatus <> 'P')
SELECT 'only_a' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT 'only_b' AS side, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
""")
def q_strict_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: rows in one output and not the other, both ways, with a tag."""
    from tablekit.operators.sets import strict_diff
    o = table(spark, sf_dir, "orders")
    a = o.select("o_orderkey", "o_orderstatus", "o_totalprice")
    b = o.filter(F.col("o_orderstatus") != "P").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.round("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return strict_diff(a, b)


@query("sorted_distinct", sql="SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def q_sorted_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_distinct(table(spark, sf_dir, "part"), "p_brand")


@query("first_n", sql="""
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1000
""")
def q_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1000 orders by date (top-k)."""
    return first_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
                   ["o_orderdate", "o_orderkey"], 1000)


@query("seeded_shuffle", sql="""
SELECT o_orderkey, md5('42|' || CAST(o_orderkey AS VARCHAR)) AS shuffle_key FROM orders
""")
def q_seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeded_shuffle(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 42)


@query("sample_rows", sql="""
SELECT vec_id, label FROM embeddings
ORDER BY md5('42|' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 8
""")
def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: eight rows of the seeded shuffle."""
    return sample_rows(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", 8, 42)


@query("row_count", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows FROM {t}" for t in TABLES))
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [row_count(table(spark, sf_dir, t)).select(F.lit(t).alias("dataset"), "rows")
             for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("value_counts", sql="SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "events"), "event_type")


_ = (url_to_file_name, with_status)
