"""Classification reports.

The data-sized work is ONE grouped count per (model, truth, prediction); all
metrics are sums over that k x k table, which is tiny and independent of the
row count.  Definitions follow the usual library ones with zero_division = 0:
precision = tp / predicted, recall = tp / support, f1 = 2 tp / (support +
predicted), each 0 when its denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, truth: str, pred: str,
                     by: list[str] | None = None) -> DataFrame:
    """(by..., truth, pred, n)."""
    by = by or []
    return (df.groupBy(*by, F.col(truth).alias("truth"), F.col(pred).alias("pred"))
              .agg(F.count(F.lit(1)).alias("n")))


def per_class(cm: DataFrame, classes: DataFrame | None = None,
              by: list[str] | None = None) -> DataFrame:
    """Per class: tp, support, predicted, precision, recall, f1.

    ``classes`` (one column ``label``) fixes the class list (J5: every class
    of the label map, also those with no rows); by default the universe is
    the labels seen in truth or prediction (U3).
    """
    by = by or []
    no = F.lit(0).cast("long")

    def counts(label, support, predicted, tp):
        return F.struct(F.col(label).alias("label"), support.alias("support"),
                        predicted.alias("predicted"), tp.alias("tp"))
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(no)
    # each matrix cell counts once for its truth and once for its prediction
    j = (cm.select(*by, F.inline(F.array(counts("truth", F.col("n"), no, hit),
                                         counts("pred", no, F.col("n"), no))))
           .groupBy(*by, "label")
           .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")]))
    if classes is not None:
        universe = classes.select("label")
        if by:
            universe = cm.select(*by).distinct().crossJoin(universe)
        j = universe.join(j, [*by, "label"], "left").fillna(0, ["support", "predicted", "tp"])
    z = F.lit(0.0)
    return j.select(
        *by, "label", "tp", "support", "predicted",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), z).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), z).alias("recall"),
        F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("support") + F.col("predicted")), z)
        .alias("f1"))


def macro_f1(cm: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Unweighted mean of class F1 over labels seen in truth or prediction."""
    by = by or []
    return per_class(cm, by=by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"),
                                                 F.count(F.lit(1)).alias("classes"))


def classification_report(cm: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Class rows plus 'accuracy', 'macro avg' and 'weighted avg' rows:
    (by..., row, precision, recall, f1, support)."""
    by = by or []
    # class rows and their totals in one pass over the class table
    g = per_class(cm, by=by).groupingSets([[*by, "label"], by], *by, "label").agg(
        F.grouping("label").alias("_total"), F.sum("tp").alias("_tp"), F.sum("support").alias("_n"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1").alias("_mf"),
        F.sum(F.col("precision") * F.col("support")).alias("_wp"),
        F.sum(F.col("recall") * F.col("support")).alias("_wr"),
        F.sum(F.col("f1") * F.col("support")).alias("_wf"))
    acc = F.try_divide(F.col("_tp").cast("double"), F.col("_n"))
    n = F.col("_n").cast("long")

    def row(name, p, r, f):
        name = F.lit(name) if isinstance(name, str) else name
        return F.struct(name.alias("row"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        n.alias("support"))
    none = F.lit(None)
    return g.select(*by, F.inline(F.when(F.col("_total") == 0, F.array(
        row(F.col("label").cast("string"), F.col("_mp"), F.col("_mr"), F.col("_mf")))).otherwise(F.array(
        row("accuracy", none, none, acc),
        row("macro avg", F.col("_mp"), F.col("_mr"), F.col("_mf")),
        row("weighted avg", F.try_divide(F.col("_wp"), F.col("_n")),
            F.try_divide(F.col("_wr"), F.col("_n")), F.try_divide(F.col("_wf"), F.col("_n")))))))


def model_matrix(df: DataFrame, truth: str, preds: dict[str, str],
                 by: list[str] | None = None) -> DataFrame:
    """(by..., model, truth, pred, n) of several prediction columns in ONE
    grouped pass: the rows are unpivoted to (model, prediction) and counted
    once."""
    by = by or []
    stack = ", ".join(f"'{m}', `{c}`" for m, c in preds.items())
    long = df.selectExpr(*[f"`{c}`" for c in by], f"`{truth}` AS truth",
                         f"stack({len(preds)}, {stack}) AS (model, pred)")
    return confusion_matrix(long, "truth", "pred", by=[*by, "model"])


def per_model_results(df: DataFrame, truth: str, preds: dict[str, str],
                      classes: DataFrame | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Class x model F1 table for several prediction columns, with the columns
    ``more`` of ``per_class``."""
    cm = model_matrix(df, truth, preds)
    return per_class(cm, classes=classes, by=["model"]).select(
        F.col("label").alias("class"), "f1", "model", *more)
