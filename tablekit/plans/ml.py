"""Registered queries: table-level ML and the ML compositions (M2-M8, M12, Z2,
Z3).  Model fits are seeded; their quality is reported, never asserted."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators import evaluation as EV
from tablekit.operators import mlops as M
from tablekit.operators import nets as N
from tablekit.operators.aggs import attach_class_weights, best_by, error_rate_monitor
from tablekit.operators.shape import align_features, drift_inject, drop_if_present
from tablekit.operators.splits import exact_random_split, fraction_slice, label_encode, stratified_split
from tablekit.operators.aggs import min_class_size
from tablekit.registry import query, scratch_dir_for, table
from tablekit.sources.sinks import append_rows, dataset_manifest, sink_split_partitions

_SPLIT = """sp AS (SELECT vec_id, embedding, label,
             row_number() OVER (ORDER BY md5('42|' || CAST(vec_id AS VARCHAR)), vec_id) AS r,
             count(*) OVER () AS n FROM embeddings)"""


@query("standardize", sql=f"""WITH {_SPLIT},
tr AS (SELECT * FROM sp WHERE r > ceil(n * 0.2)),
ex AS (SELECT unnest(generate_series(1, len(embedding))) AS pos,
              CAST(unnest(embedding) AS DOUBLE) AS x FROM tr),
st AS (SELECT pos, avg(x) AS m, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sd
       FROM ex GROUP BY pos),
ms AS (SELECT list(m ORDER BY pos) AS means, list(sd ORDER BY pos) AS sds FROM st)
SELECT vec_id, pos - 1 AS pos, round((x - means[pos]) / sds[pos], 6) + 0.0 AS value
FROM (SELECT vec_id, unnest(generate_series(1, len(embedding))) AS pos,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), ms""")
def q_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: statistics fitted on the training rows (exact 80 %), population
    sd, applied to all rows."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    train = exact_random_split(e, "vec_id", 0.2, 42).filter(F.col("split") == "train")
    s = M.standardize(e, "embedding", fit_on=train, out="standardized")
    # one row per value, to 6 digits: the statistics' last bits depend on the
    # order of the sums
    return s.select("vec_id", F.posexplode("standardized").alias("pos", "value")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query("pca_whiten")
def q_pca_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: 8 whitened components (unit variance on the training rows)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return M.pca_whiten(e, "embedding", 8).select("vec_id", "label", "pca")


def part_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor stand-in: target = p_size > 25; type = brand; order = key."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice",
                    (F.col("p_size") > 25).cast("int").alias("label"))


def _forest(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None):
    d = part_frame(spark, sf_dir) if rows is None else rows
    sp = exact_random_split(d, "p_partkey", 0.2, 42)
    train = sp.filter(F.col("split") == "train")
    test = sp.filter(F.col("split") == "test")
    pipe = M.indexed_pipeline(["p_brand", "p_type"], ["p_retailprice"], M.random_forest(50, 42))
    return pipe.fit(train), train, test


@query("random_forest")
def q_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M8: 50 seeded trees; prediction and P(class 1) on the test rows."""
    model, _, test = _forest(spark, sf_dir)
    s = M.batch_score(model, test)
    return s.select("p_partkey", "label", F.col("prediction").cast("int").alias("prediction"),
                    F.round("p_positive", 6).alias("p_positive"))


@query("model_store")
def q_model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: the fitted pipeline saved, loaded, and scoring the same rows."""
    model, _, test = _forest(spark, sf_dir)
    loaded = M.model_store(model, scratch_dir_for(spark, "forest_model"))
    a = model.transform(test).select("p_partkey", F.col("prediction").alias("a"))
    b = loaded.transform(test).select("p_partkey", F.col("prediction").alias("b"))
    return a.join(b, "p_partkey").agg(F.count(F.lit(1)).alias("rows"),
                                      F.count_if(F.col("a") != F.col("b")).alias("differences"))


def _emb_train_test(spark: SparkSession, sf_dir: str):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    sp = stratified_split(e, "label", "vec_id", 0.1, 0.2, 42)
    train = sp.filter(F.col("split") == "train")
    std = M.standardize(sp, "embedding", fit_on=train, out="std")
    std = M.training_frame(std.withColumn("features", array_to_vector("std")))
    return std.filter(F.col("split") == "train"), std.filter(F.col("split") == "test")


def _kernel_svm(train: DataFrame, test: DataFrame, col: str = "std", label: str = "label") -> DataFrame:
    """Test rows with the prediction of a balanced kernel machine.  Rows are
    dealt over the cores before they are lifted, and gathered for the fits; as
    many classes are fitted side by side as the lifted rows' size allows."""
    size, rows = train.agg(F.max(F.size(col)), F.count(F.lit(1))).first()
    gamma, features = N.scale_gamma(train, col), 512

    def lifted(df: DataFrame) -> DataFrame:
        lifts = N.rbf_features(df, col, gamma, size, features=features)
        return lifts.withColumn("features", array_to_vector("rbf")).drop("rbf")
    frame = M.training_frame(lifted(attach_class_weights(M.spread_rows(train, rows), label)))
    fits = M.fits_at_once(rows, features)
    m = M.balanced_svm(label, weight="balanced_weight", parallelism=fits).fit(M.gather_rows(frame, rows, fits))
    return m.transform(lifted(test))


@query("balanced_svm")
def q_balanced_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + G23: one-vs-rest SVM with a Gaussian kernel (random Fourier
    features before the linear solver) and balanced class weights."""
    train, test = _emb_train_test(spark, sf_dir)
    return _kernel_svm(train, test).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


@query("rbf_kernel", sql="""
SELECT a.vec_id, b.vec_id AS other, round(exp(-list_sum(list_transform(range(1, 65),
         lambda i: (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2)) / 64), 6) AS kernel, true AS close
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def q_rbf_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5's kernel: of each vector and the next the exact value, and whether
    the features' dot product comes within 0.15 of it.  Vectors are joined
    before they are lifted: 64 numbers a row are shuffled, not 2,048."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    e = e.join(e.select(F.col("vec_id").alias("other"), F.col("embedding").alias("x")),
               F.col("other") == F.col("vec_id") + 1)
    for col, out in (("embedding", "rbf"), ("x", "z")):
        e = N.rbf_features(e, col, 1 / 64, 64, features=2048, out=out)
    add = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, v: s + v)
    exact = F.exp(-add(F.zip_with("embedding", "x", lambda p, q: F.pow(p.cast("double") - q.cast("double"), F.lit(2.0))))
                  / 64)
    near = add(F.zip_with("rbf", "z", lambda p, q: p * q))
    return e.select(
        "vec_id", "other", F.round(exact, 6).alias("kernel"), (F.abs(near - exact) < 0.15).alias("close"))


def _layers(train: DataFrame, hidden: tuple[int, ...] = (32,), label: str = "label") -> list[int]:
    """Layer sizes from the training rows: vector length and label range."""
    n, top = train.agg(F.max(F.size("std")), F.max(label)).first()
    return [n, *hidden, int(top) + 1]


@query("mlp_classifier")
def q_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: one hidden layer of 32 with batch normalisation and dropout,
    trained on mini-batches."""
    train, test = _emb_train_test(spark, sf_dir)
    net, _ = N.train_net(train, _layers(train), "std", "label", "vec_id", epochs=15)
    return N.score_net(test, net, "std").select("vec_id", "label", "prediction")


@query("grid_runs")
def q_grid_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated fits over a parameter grid; one row per run."""
    train, _ = _emb_train_test(spark, sf_dir)
    from pyspark.ml.classification import RandomForestClassifier
    rf = RandomForestClassifier(seed=42, labelCol="label", featuresCol="features")
    _, runs = M.grid_runs(rf, {"numTrees": [5, 10], "maxDepth": [3, 5]}, train, folds=2)
    return runs


@query("identification_report")
def q_identification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z3: class filter, labels encoded, stratified split written one folder a
    split and read again, standardise, whitened components for the kernel
    machine, network of three hidden layers on the standardised features,
    stopped early on the validation split.  One row per class of the label map
    and model, of the test split: F1, precision, recall and support, and by
    model the macro F1, the validation macro F1 (the network's best epoch), the
    name of the best model and the summary rows of the classification report."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    kept, _ = min_class_size(e, ["label"], 3)
    coded, classes = label_encode(kept, "label", "label_idx")
    path = scratch_dir_for(spark, "report_splits")
    sink_split_partitions(stratified_split(coded, "label", "vec_id", 0.1, 0.2, 42), path)
    sp = spark.read.parquet(path)
    train = sp.filter(F.col("split") == "train")
    std = M.training_frame(M.standardize(sp, "embedding", fit_on=train, out="std"))
    white = M.training_frame(M.pca_whiten(std.filter(F.col("split") == "train"), "std", 16, apply_to=std))
    tr = white.filter(F.col("split") == "train")
    net, history = N.train_net(tr, _layers(tr, (512, 256, 128), "label_idx"), "std", "label_idx", "vec_id",
                               epochs=50, val=white.filter(F.col("split") == "val"), patience=10)
    scored = _kernel_svm(tr.select("label_idx", "pca"), white.filter(F.col("split") != "train"), "pca", "label_idx")
    both = N.score_net(scored, net, "std", "mlp")
    both = M.training_frame(both.select("split", "label_idx", F.col("prediction").cast("int").alias("svm"), "mlp"))
    models = {"svm": "svm", "mlp": "mlp"}
    cm = M.training_frame(EV.model_matrix(both, "label_idx", models, by=["split"]))  # classes x classes
    on_test = cm.filter(F.col("split") == "test").drop("split")
    scores = (EV.macro_f1(cm, by=["split", "model"]).groupBy("model")
              .agg(*[F.max(F.when(F.col("split") == s, F.col("macro_f1"))).alias(c)
                     for s, c in (("test", "macro_f1"), ("val", "val_macro_f1"))])
              .withColumn("val_macro_f1", F.when(F.col("model") == "mlp", F.lit(max(f1 for *_, f1 in history)))
                          .otherwise(F.col("val_macro_f1")))
              .withColumn("nth", F.when(F.col("model") == "svm", 0).otherwise(1)))
    best = best_by(scores, "model", "macro_f1", order="nth").select("best_model")
    rows = EV.classification_report(on_test, by=["model"])
    report = (rows.filter(F.col("row").isin("accuracy", "macro avg", "weighted avg")).groupBy("model")
              .agg(F.array_sort(F.collect_list(F.struct("row", "precision", "recall", "f1", "support")))
                   .alias("report")))
    found = EV.per_model_results(both.filter(F.col("split") == "test"), "label_idx", models,
                                 classes.select(F.col("label_idx").alias("label")), ("precision", "recall", "support"))
    names = classes.select(F.col("label_idx").alias("class"), F.col("label").cast("double").alias("name"))
    return (found.join(F.broadcast(names), "class").join(F.broadcast(scores), "model")
            .join(F.broadcast(report), "model").crossJoin(F.broadcast(best))
            .select(F.col("name").alias("class"), "f1", "model", "precision", "recall", "support",
                    "macro_f1", "val_macro_f1", "best_model", "report"))


@query("maintenance_cycle")
def q_maintenance_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepare (drop ids, encode, chronological slice, manifest), train
    (the first 70 % of rows in order, exact split, forest, registry row with
    the test accuracy), drift the next slice, which training never saw, align
    the scoring frame to the model columns, score and monitor the error rate."""
    d = drop_if_present(part_frame(spark, sf_dir), ["p_name", "UDI"])
    manifest = dataset_manifest(d, "v1", "part", "tablekit", ["dropped p_name"])
    model, _, test = _forest(spark, sf_dir, fraction_slice(d, ["p_partkey"], 0.0, 0.7))
    acc = error_rate_monitor(M.batch_score(model, test), "prediction", "label")
    store = scratch_dir_for(spark, "model_registry")
    append_rows(spark.range(1).crossJoin(acc).select(
        F.lit("forest").alias("model"), F.lit("v1").alias("data"), "accuracy",
        F.current_timestamp().alias("trained_at")), store)
    reg = spark.read.parquet(store)
    nxt = fraction_slice(d, ["p_partkey"], 0.7, 0.8)  # the next 10 % after training
    drifted = drift_inject(nxt, key="p_partkey", shift={"p_retailprice": 1.0},
                           scale={"p_retailprice": 1.01}, sd=0.05, seed=7, exclude=["label"])
    aligned, _ = align_features(drifted, ["p_partkey", "p_brand", "p_type", "p_retailprice", "label"])
    mon = error_rate_monitor(M.batch_score(model, aligned), "prediction", "label")
    return (mon.select(F.lit("drifted").alias("slice"), "rows", F.round("error", 6).alias("error"),
                       "retrain")
               .unionByName(acc.select(F.lit("test").alias("slice"), "rows",
                                       F.round("error", 6).alias("error"), "retrain"))
               .crossJoin(manifest.select(F.col("rows").alias("dataset_rows")))
               .crossJoin(reg.select("model", F.round("accuracy", 6).alias("accuracy"))))
