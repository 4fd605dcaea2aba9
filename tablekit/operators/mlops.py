"""Table-level machine learning (M2-M8, M12, M13) on ``pyspark.ml``.

Fits are distributed by Spark ML (tree aggregation); statistics for array
features are grouped aggregates over ``posexplode``.  The only rows that
reach the driver are model parameters and per-dimension statistics, whose
size is bounded by the feature dimension, not by the data.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LinearSVC, MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- M13
def signature_check(df: DataFrame, expected: dict[str, str],
                    shapes: dict[str, int] | None = None) -> DataFrame:
    """Column presence / type contract from the schema (driver-side, no
    data) plus one aggregate counting rows whose arrays have the wrong
    length.  Output: rows, bad_shape, schema_ok."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema_ok = all(have.get(c) == t for c, t in expected.items())
    bad = F.lit(False)
    for c, n in (shapes or {}).items():
        bad = bad | F.col(c).isNull() | (F.size(c) != n)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad_shape")) \
             .withColumn("schema_ok", F.lit(schema_ok))


# ---------------------------------------------------------------- M2
def array_stats(df: DataFrame, col: str) -> DataFrame:
    """Per position of an array column: mean and population sd (one row of
    arrays; its size is the array length)."""
    ex = df.select(F.posexplode(col).alias("pos", "x"))
    g = ex.groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("mean"),
                              F.stddev_pop(F.col("x").cast("double")).alias("sd"))
    s = g.agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "sd"))).alias("_s"))
    return s.select(F.transform("_s", lambda r: r["mean"]).alias("means"),
                    F.transform("_s", lambda r: F.when(r["sd"] == 0, F.lit(1.0))
                                .otherwise(r["sd"])).alias("sds"))


def standardize(df: DataFrame, col: str, fit_on: DataFrame | None = None,
                out: str | None = None) -> DataFrame:
    """(x - mean) / sd per position, statistics fitted on ``fit_on`` (the
    training rows) with the population sd; constant positions scale by 1."""
    stats = array_stats(fit_on if fit_on is not None else df, col)
    out = out or col
    j = df.crossJoin(F.broadcast(stats))  # one row, bounded by the array length
    return j.withColumn(out, F.transform(col, lambda x, i: (x.cast("double") - F.col("means")[i])
                                         / F.col("sds")[i])).drop("means", "sds")


# ---------------------------------------------------------------- M3
def pca_whiten(train: DataFrame, col: str, k: int, apply_to: DataFrame | None = None,
               out: str = "pca") -> DataFrame:
    """Centre with the training means, project on k components, divide each
    component by its training sd (unit variance).  Component signs are free."""
    means = array_stats(train, col).select("means")

    def centre(d):
        return (d.crossJoin(F.broadcast(means))
                 .withColumn("_v", array_to_vector(F.transform(col, lambda x, i: x.cast("double")
                                                               - F.col("means")[i])))
                 .drop("means"))
    tr = centre(train)
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(tr)
    proj_tr = model.transform(tr).withColumn("_pa", vector_to_array("_p"))
    sds = array_stats(proj_tr, "_pa").select(F.col("sds").alias("_psd"))
    target = centre(apply_to if apply_to is not None else train)
    res = model.transform(target).withColumn("_pa", vector_to_array("_p")).crossJoin(F.broadcast(sds))
    return res.withColumn(out, F.transform("_pa", lambda x, i: x / F.col("_psd")[i])).drop(
        "_v", "_p", "_pa", "_psd")


# ---------------------------------------------------------------- M4 / M5 / M6
def training_frame(df: DataFrame) -> DataFrame:
    """Cut the lineage before an iterative fit: a reliable checkpoint in the
    session's shared checkpoint folder (survives lost executors)."""
    from tablekit.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows that make a task worth its start, and rows of a fit's task at most
#: (128 MB at 512 features).
TASK_ROWS, FIT_ROWS = 1 << 13, 1 << 15
#: Feature values that fits running side by side may hold, each its own copy
#: (4 GB over all executors).
FIT_VALUES = 1 << 29


def spread_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` rows over the cores, ``TASK_ROWS`` a task at least
    and ``FIT_ROWS`` at most; a frame of that many partitions stays as it is."""
    want = max(min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), -(-rows // FIT_ROWS))
    return df.repartition(want) if want > df.rdd.getNumPartitions() else df


def gather_rows(df: DataFrame, rows: int, fits: int) -> DataFrame:
    """``df`` in fewer partitions for ``fits`` fits side by side: each
    evaluation of a fit starts a task a partition and adds their results up,
    so a partition takes ``FIT_ROWS`` rows where the fits fill the cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(2, -(-cores // fits), -(-rows // FIT_ROWS)))


def fits_at_once(rows: int, features: int, most: int = 8) -> int:
    """Fits to run side by side on ``rows`` of ``features`` values: together
    they hold ``FIT_VALUES`` at most, unless one alone holds more."""
    return max(1, min(most, FIT_VALUES // max(1, rows * features)))


def feature_vector(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def random_forest(num_trees: int = 50, seed: int = 42, label: str = "label",
                  features: str = "features") -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=num_trees, seed=seed, labelCol=label,
                                  featuresCol=features)


def balanced_svm(label: str = "label", features: str = "features", weight: str | None = None,
                 reg: float = 0.01, max_iter: int = 20, parallelism: int = 8) -> OneVsRest:
    """One-vs-rest linear SVM (Spark has no kernel SVM); class weights from
    ``attach_class_weights`` go in ``weight``; the per-class fits run
    ``parallelism`` at a time."""
    svc = LinearSVC(regParam=reg, maxIter=max_iter)
    if weight:
        svc = svc.setWeightCol(weight)
    ovr = OneVsRest(classifier=svc, labelCol=label, featuresCol=features, parallelism=parallelism)
    if weight:
        ovr = ovr.setWeightCol(weight)
    return ovr


def mlp(layers: list[int], seed: int = 42, label: str = "label", features: str = "features",
        max_iter: int = 100) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=layers, seed=seed, labelCol=label,
                                          featuresCol=features, maxIter=max_iter)


# ---------------------------------------------------------------- M7
def model_store(model: PipelineModel, path: str) -> PipelineModel:
    """Save (overwrite) and load back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


# ---------------------------------------------------------------- M8
def batch_score(model, df: DataFrame, positive: int = 1) -> DataFrame:
    """Prediction and P(class ``positive``)."""
    s = model.transform(df)
    if "probability" in s.columns:
        s = s.withColumn("p_positive", vector_to_array("probability")[positive])
    return s


# ---------------------------------------------------------------- M12
def grid_runs(estimator, grid: dict, train: DataFrame, label: str = "label",
              folds: int = 3, parallelism: int = 2, seed: int = 42):
    """Fit over parameter combinations (cross-validated, fits in parallel);
    returns (best model, rows of (run, params..., metric))."""
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(getattr(estimator, p), vals)
    maps = b.build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                        numFolds=folds, parallelism=parallelism, seed=seed)
    m = cv.fit(train)
    rows = [(i, *[str(pm[getattr(estimator, p)]) for p in grid], float(metric))
            for i, (pm, metric) in enumerate(zip(maps, m.avgMetrics))]
    schema = T.StructType([T.StructField("run", T.IntegerType())] +
                          [T.StructField(p, T.StringType()) for p in grid] +
                          [T.StructField("f1", T.DoubleType())])
    return m.bestModel, train.sparkSession.createDataFrame(rows, schema)


def indexed_pipeline(cat_cols: list[str], num_cols: list[str], estimator) -> Pipeline:
    """Label-encode text columns (alphabetical), assemble, fit."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep") for c in cat_cols]
    asm = VectorAssembler(inputCols=[f"{c}_idx" for c in cat_cols] + num_cols,
                          outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[*idx, asm, estimator])
