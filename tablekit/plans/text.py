"""Registered queries: links, entities and the crawl table (X10, X11, X19,
Z5 with K7 K8 G18 F7, Z7 text batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions.text import (base64_text, entities, entity_count_by_rule, extract_links, join_list,
                                     tokenize_ws, url_to_file_name)
from tablekit.operators.aggs import threshold_notify, value_counts
from tablekit.operators.shape import fill_defaults, status_filter, validate_nonempty
from tablekit.registry import query, table
from tablekit.sources.sinks import insert_or_ignore

def _links_sql(tag: str, attr: str) -> str:
    """Written apart from the operator: whole tags first, then the attribute."""
    return rf"""list_filter(list_transform(
    regexp_extract_all(
      regexp_replace(regexp_replace(regexp_replace(html, '<!--(?s:.)*?-->', '', 'g'),
        '(?i)<script\b(?s:.)*?</script\s*>', '', 'g'), '(?i)<style\b(?s:.)*?</style\s*>', '', 'g'),
      '(?i)<{tag}[\s/](?:"[^"]*"|''[^'']*''|[^>"''])*>'),
    lambda t: replace(trim(regexp_extract(t, '(?i)[\s/]{attr}\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1),
                           '"'''), '&amp;', '&')),
  lambda v: v <> '')"""


_LINKS_SQL, _IMAGES_SQL = _links_sql("a", "href"), _links_sql("img", "src")


@query("extract_links", sql=f"""
SELECT page_id, array_to_string({_LINKS_SQL}, ',') AS links, len({_LINKS_SQL}) AS n_links FROM pages""")
def q_extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 + X10: all non-empty href values of a tags in page order, joined
    by commas (the driver's pages hold no img tags; img/src is unit-tested and
    has its own column in the crawl table)."""
    p = table(spark, sf_dir, "pages")
    links = extract_links("html", "a", "href")
    return p.select("page_id", join_list(links).alias("links"),
                    F.size(links).cast("long").alias("n_links"))


# the rules in SQL's own words: label -> pattern, tried in this order
_ENTITY_SQL = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "MONEY": r"(?:\$|€|£)[0-9]+(?:[.,][0-9]+)?",
    "DATE": r"\d{4}-\d{2}-\d{2}",
    "NUMBER": r"\d+(?:\.\d+)?",
    "PROPER": r"[A-Z][a-z]+(?: [A-Z][a-z]+)+",
}
_ANY_ENTITY = "|".join(_ENTITY_SQL.values())
_LABEL_SQL = "CASE " + " ".join(
    f"WHEN regexp_full_match(text, '{p}') THEN '{k}'" for k, p in _ENTITY_SQL.items()) + " END"


@query("entities_to_struct", sql=f"""
SELECT {_LABEL_SQL} AS label, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(text, '{_ANY_ENTITY}')) AS text FROM documents) GROUP BY ALL""")
def q_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of every whole document as array<struct(text, label,
    start, end)>, exploded and counted by label."""
    d = table(spark, sf_dir, "documents")
    # an outer explode: for an inner one the optimizer would find the entities
    # once more to filter by their number
    e = d.select(F.explode_outer(entities("text")).alias("e")).filter("e is not null")
    return value_counts(e.select(F.col("e.label").alias("label")), "label")


@query("entity_offsets", sql=f"""
WITH m AS (SELECT doc_id, regexp_extract_all(text, '{_ANY_ENTITY}') AS e,
                  string_split_regex(text, '{_ANY_ENTITY}') AS g FROM documents),
x AS (SELECT doc_id, unnest(e) AS text, unnest(range(1, len(e) + 1)) AS i,
             list_transform(e, lambda v: length(v)) AS el, list_transform(g, lambda v: length(v)) AS gl FROM m),
s AS (SELECT doc_id, text, list_sum(gl[1:i]) + coalesce(list_sum(el[1:i - 1]), 0) AS start FROM x)
SELECT doc_id, text, {_LABEL_SQL} AS label, start::INTEGER AS start,
       (start + length(text))::INTEGER AS "end" FROM s""")
def q_entity_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19 rows: (doc_id, text, label, start, end) per entity."""
    d = table(spark, sf_dir, "documents")
    return (d.select("doc_id", F.explode_outer(entities("text")).alias("e")).filter("e is not null")
            .select("doc_id", "e.*"))


# ------------------------------------------------------------------ Z5 crawl
def crawl_batch(pages: DataFrame) -> DataFrame:
    """One crawl run over a URL list: page rows with derived path, the images
    they show, the pages they link to and status (plain http failed to fetch
    in the source's scenario)."""
    ok = F.col("url").startswith("https")
    return pages.select(
        "page_id", "url",
        F.when(ok, url_to_file_name("url", "/data/scraped")).otherwise(F.lit("")).alias("html_path"),
        F.when(ok, join_list(extract_links("html", "img", "src"))).otherwise(F.lit("")).alias("images"),
        F.when(ok, join_list(extract_links("html", "a", "href"))).otherwise(F.lit("")).alias("links"),
        F.when(ok, "success").otherwise("failed").alias("status"))


@query("crawl_table", sql=f"""
WITH b AS (
  SELECT page_id, url,
         CASE WHEN url LIKE 'https%' THEN '/data/scraped/' || replace(replace(replace(url, 'https://', ''),
              'http://', ''), '/', '_') || '.html' ELSE '' END AS html_path,
         CASE WHEN url LIKE 'https%' THEN array_to_string({_IMAGES_SQL}, ',') ELSE '' END AS images,
         CASE WHEN url LIKE 'https%' THEN array_to_string({_LINKS_SQL}, ',') ELSE '' END AS links,
         CASE WHEN url LIKE 'https%' THEN 'success' ELSE 'failed' END AS status
  FROM pages)
SELECT row_number() OVER (ORDER BY page_id) AS id, url, html_path, images, links, status FROM b""")
def q_crawl_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run into an empty table: insert-or-ignore on the unique URL,
    ids numbered in page order."""
    batch = crawl_batch(table(spark, sf_dir, "pages"))
    empty = batch.limit(0).select(F.lit(0).cast("long").alias("id"), "url")
    return insert_or_ignore(empty, batch, "url", ["page_id"]).select(
        "id", "url", "html_path", "images", "links", "status")


@query("threshold_notify", sql="""
SELECT count(*) FILTER (WHERE url LIKE 'https%') AS count,
       'stored pages: ' ||
       CAST(count(*) FILTER (WHERE url LIKE 'https%') AS VARCHAR) AS notice
FROM pages HAVING count(*) FILTER (WHERE url LIKE 'https%') >= 2""")
def q_threshold_notify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G18 + F7: one notice when the stored successes reach the limit (2)."""
    return threshold_notify(crawl_batch(table(spark, sf_dir, "pages")), 2)


@query("tokenize_ws", sql=r"""
SELECT doc_id, CAST(coalesce(len(w), -1) AS INTEGER) AS n_tokens,
       CAST(coalesce(len(list_distinct(w)), -1) AS INTEGER) AS n_distinct
FROM (SELECT doc_id, regexp_extract_all(text, '[^\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+') AS w FROM documents)""")
def q_tokenize_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White-space tokens of each whole text and how many differ."""
    return table(spark, sf_dir, "documents").withColumn("w", tokenize_ws("text")).select(
        "doc_id", F.coalesce(F.size("w"), F.lit(-1)).alias("n_tokens"),
        F.coalesce(F.size(F.array_distinct("w")), F.lit(-1)).alias("n_distinct"))


@query("status_filter", sql="SELECT page_id, url FROM pages WHERE url LIKE 'https%'")
def q_status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows with status = 'success'."""
    return status_filter(crawl_batch(table(spark, sf_dir, "pages"))).select("page_id", "url")


# ------------------------------------------------------------------ Z7 text batch
@query("text_batch", sql=r"""
WITH r AS (SELECT text AS body, CASE WHEN role = 'user' THEN NULL ELSE role END AS target_lang
           FROM conversations),
o AS (SELECT *, body IS NULL OR regexp_replace(body, '\s', '', 'g') = '' AS empty FROM r)
SELECT CASE WHEN empty THEN 'rejected' ELSE 'accepted' END AS outcome,
       coalesce(target_lang, 'es') AS target_lang, count(*) AS n,
       CAST(sum(CASE WHEN empty THEN 0 ELSE length(to_base64(encode(body))) END) AS BIGINT) AS payload_chars,
       CAST(sum(CASE WHEN empty THEN 0 ELSE len(regexp_extract_all(
           body, '[A-Z][a-z]+(?: [A-Z][a-z]+)+')) END) AS BIGINT) AS proper_names,
       count(*) FILTER (WHERE empty) AS errors
FROM o GROUP BY ALL""")
def q_text_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests (whole turns) get defaults and validation; accepted ones
    are encoded and their entities found, rejected ones carry their error.
    Counts per (outcome, target language)."""
    c = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("body"),
        F.when(F.col("role") != "user", F.col("role")).alias("target_lang"))
    c = fill_defaults(c, {"target_lang": "es"})
    valid, bad = validate_nonempty(c, "body", strict=True)
    ok = valid.select("target_lang", F.lit("accepted").alias("outcome"),
                      F.length(base64_text("body")).alias("chars"),
                      entity_count_by_rule("body", "PROPER").alias("names"),
                      F.lit(None).cast("string").alias("error"))
    no = bad.select("target_lang", F.lit("rejected").alias("outcome"), F.lit(0).alias("chars"),
                    F.lit(0).alias("names"), F.col("reason").alias("error"))
    return ok.unionByName(no).groupBy("outcome", "target_lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("payload_chars"),
        F.sum("names").alias("proper_names"), F.count("error").alias("errors"))
