"""Registered queries: model-evaluation reports.

Truth and predictions from the driver's tables: ``labels.quality`` against a
length rule on ``documents.n_chars`` (binary), and ``embeddings.label``
against the arg-max of ten scores read off the whole embedding (class j sums
the values at positions j, j + 10, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions.arrays import argmax, class_logits
from tablekit.operators import evaluation as EV
from tablekit.operators.aggs import best_by, best_metric, class_count, error_rate_monitor
from tablekit.operators.shape import feature_target_split
from tablekit.operators.sets import concat_results, label_universe
from tablekit.registry import query, table

CLASSES = 10                      # scores read off an embedding
LIMIT = 1000                      # rule: a document is "good" when n_chars >= LIMIT
RULES = {"short_rule": 500, "mid_rule": 1000, "long_rule": 2000}


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    d = lab.join(docs, "doc_id", "inner")
    return d.select("doc_id", "lang", F.col("quality").alias("truth"),
                    *[(F.col("n_chars") >= lim).cast("int").alias(m) for m, lim in RULES.items()],
                    (F.col("n_chars") >= LIMIT).cast("int").alias("pred"))


def embedding_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").alias("truth"),
                    argmax(class_logits("embedding", CLASSES)).alias("pred"))


_DOCS = f"""d AS (
  SELECT l.doc_id, d.lang, l.quality AS truth, CAST(d.n_chars >= {LIMIT} AS INTEGER) AS pred,
         {", ".join(f"CAST(d.n_chars >= {v} AS INTEGER) AS {k}" for k, v in RULES.items())}
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
_EMB = f"""p AS (
  SELECT vec_id, label, (pos - 1) % {CLASSES} AS j, sum(CAST(v AS DOUBLE)) AS score
  FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos
        FROM embeddings) GROUP BY ALL),
d AS (SELECT vec_id, label AS truth, CAST(arg_max(j, score) AS INTEGER) AS pred FROM p GROUP BY ALL)"""


def _pc_sql(universe: str | None = None) -> str:
    u = universe or "SELECT label FROM sup UNION SELECT label FROM prd"
    return f"""cm AS (SELECT truth, pred, count(*) AS n FROM d GROUP BY truth, pred),
sup AS (SELECT truth AS label, CAST(sum(n) AS BIGINT) AS support FROM cm GROUP BY 1),
prd AS (SELECT pred AS label, CAST(sum(n) AS BIGINT) AS predicted FROM cm GROUP BY 1),
tpt AS (SELECT truth AS label, CAST(sum(n) AS BIGINT) AS tp FROM cm WHERE truth = pred GROUP BY 1),
u AS ({u}),
pc AS (
  SELECT u.label, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support,
         coalesce(predicted, 0) AS predicted
  FROM u LEFT JOIN sup ON sup.label = u.label LEFT JOIN prd ON prd.label = u.label
         LEFT JOIN tpt ON tpt.label = u.label),
m AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
            CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall,
            CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2.0 * tp / (support + predicted) END AS f1
  FROM pc)"""


def _r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("confusion_matrix", sql=f"WITH {_DOCS} SELECT truth, pred, count(*) AS n FROM d GROUP BY ALL")
def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.confusion_matrix(labelled_docs(spark, sf_dir), "truth", "pred")


@query("per_class_f1", sql=f"""WITH {_EMB}, {_pc_sql()}
SELECT label, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM m""")
def q_per_class_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = EV.confusion_matrix(embedding_preds(spark, sf_dir), "truth", "pred")
    return _r6(EV.per_class(cm), ["precision", "recall", "f1"])


@query("full_class_join", sql=f"""WITH {_EMB}, {_pc_sql("SELECT DISTINCT label FROM embeddings")}
SELECT label, tp, support, predicted, round(f1, 6) AS f1 FROM m""")
def q_full_class_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every class of the label map, zero rows included."""
    classes = table(spark, sf_dir, "embeddings").select("label").distinct()
    cm = EV.confusion_matrix(embedding_preds(spark, sf_dir), "truth", "pred")
    return _r6(EV.per_class(cm, classes=classes), ["f1"]).select(
        "label", "tp", "support", "predicted", "f1")


@query("macro_f1", sql=f"""WITH {_EMB}, {_pc_sql()}
SELECT round(avg(f1), 6) AS macro_f1, count(*) AS classes FROM m""")
def q_macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = EV.confusion_matrix(embedding_preds(spark, sf_dir), "truth", "pred")
    return _r6(EV.macro_f1(cm), ["macro_f1"])


@query("classification_report", sql=f"""WITH {_DOCS}, {_pc_sql()},
tot AS (SELECT sum(tp) AS tp, sum(support) AS n, avg(precision) AS mp, avg(recall) AS mr,
               avg(f1) AS mf, sum(precision * support) AS wp, sum(recall * support) AS wr,
               sum(f1 * support) AS wf FROM m)
SELECT CAST(label AS VARCHAR) AS row, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round(tp / n, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT)
FROM tot""")
def q_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = EV.confusion_matrix(labelled_docs(spark, sf_dir), "truth", "pred")
    return _r6(EV.classification_report(cm), ["precision", "recall", "f1"])


@query("label_universe", sql=f"""WITH {_EMB}
SELECT truth AS label FROM d UNION SELECT pred FROM d""")
def q_label_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_universe(embedding_preds(spark, sf_dir), "truth", "pred")


@query("per_model_results", sql=f"""WITH {_DOCS},
long AS (
  SELECT truth, 'short_rule' AS model, short_rule AS pred FROM d
  UNION ALL SELECT truth, 'mid_rule', mid_rule FROM d
  UNION ALL SELECT truth, 'long_rule', long_rule FROM d),
cm AS (SELECT model, truth, pred, count(*) AS n FROM long GROUP BY ALL),
sup AS (SELECT model, truth AS label, sum(n) AS support FROM cm GROUP BY ALL),
prd AS (SELECT model, pred AS label, sum(n) AS predicted FROM cm GROUP BY ALL),
tpt AS (SELECT model, truth AS label, sum(n) AS tp FROM cm WHERE truth = pred GROUP BY ALL),
u AS (SELECT model, label FROM sup UNION SELECT model, label FROM prd)
SELECT u.label AS class,
       round(CASE WHEN coalesce(support, 0) + coalesce(predicted, 0) = 0 THEN 0.0
             ELSE 2.0 * coalesce(tp, 0) / (coalesce(support, 0) + coalesce(predicted, 0)) END, 6) AS f1,
       u.model
FROM u LEFT JOIN sup USING (model, label) LEFT JOIN prd USING (model, label)
       LEFT JOIN tpt USING (model, label)""")
def q_per_model_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class x model F1 for three rules in one grouped pass."""
    d = labelled_docs(spark, sf_dir)
    return _r6(EV.per_model_results(d, "truth", {m: m for m in RULES}), ["f1"])


@query("concat_results", sql=f"""WITH {_DOCS}
SELECT 'short_rule' AS model, truth, short_rule AS pred, count(*) AS n FROM d GROUP BY ALL
UNION ALL SELECT 'long_rule', truth, long_rule, count(*) FROM d GROUP BY ALL""")
def q_concat_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2 + P12: per-model result frames, tagged and stacked."""
    d = labelled_docs(spark, sf_dir)
    frames = {m: EV.confusion_matrix(d, "truth", m) for m in ("short_rule", "long_rule")}
    return concat_results(frames).select("model", "truth", "pred", "n")


@query("error_rate_monitor", sql=f"""WITH {_DOCS}
SELECT lang, count(*) AS rows, round(avg(CAST(pred = truth AS DOUBLE)), 6) AS accuracy,
       round(1 - avg(CAST(pred = truth AS DOUBLE)), 6) AS error,
       1 - avg(CAST(pred = truth AS DOUBLE)) > 0.25 AS retrain
FROM d GROUP BY lang""")
def q_error_rate_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 per language: retrain when error > 0.25 (strict)."""
    m = error_rate_monitor(labelled_docs(spark, sf_dir), "pred", "truth", 0.25, by=["lang"])
    return m.select("lang", "rows", F.round("accuracy", 6).alias("accuracy"),
                    F.round("error", 6).alias("error"), "retrain")


@query("best_model", sql="""
WITH rev AS (
  SELECT s.s_nationkey, s.s_suppkey, s.s_name,
         round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey GROUP BY ALL)
SELECT s_nationkey, s_name AS best_s_name, revenue AS best_revenue FROM rev
QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY revenue DESC, s_suppkey) = 1""")
def q_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best supplier per nation by revenue; a tie goes to the first key."""
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rev = (li.groupBy("l_suppkey")
             .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
                  .alias("revenue"))
             .join(sup, F.col("l_suppkey") == F.col("s_suppkey")))
    return best_by(rev, "s_name", "revenue", order="s_suppkey", by=["s_nationkey"])


@query("best_metric", sql="SELECT user_id, max(value) AS best_value FROM events GROUP BY user_id")
def q_best_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_metric(table(spark, sf_dir, "events"), "value", ["user_id"])


@query("feature_target_split", sql="""
SELECT quality, count(*) AS rows, CAST(sum(toxic) AS BIGINT) AS toxic FROM labels GROUP BY quality""")
def q_feature_target_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature columns summed per value of the target."""
    lab = table(spark, sf_dir, "labels").drop("doc_id")
    features, target = feature_target_split(lab, "quality")
    return lab.groupBy(target).agg(F.count(F.lit(1)).alias("rows"),
                                   *[F.sum(c).alias(c) for c in features])


@query("class_count", sql="SELECT count(DISTINCT label) AS classes FROM embeddings")
def q_class_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_count(table(spark, sf_dir, "embeddings"), "label")
