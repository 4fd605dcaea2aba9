"""Sinks (K1-K9).  Every sink is one distributed write; nothing passes
through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.text import url_to_file_name


# ---------------------------------------------------------------- K1 / K2 / K3 / K4
def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def sink_split_partitions(df: DataFrame, path: str, split: str = "split",
                          fmt: str = "parquet") -> None:
    """All splits in one job, one folder per split value."""
    df.write.mode("overwrite").partitionBy(split).format(fmt).save(path)


def sink_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


# ---------------------------------------------------------------- K5
def dataset_manifest(df: DataFrame, version: str, source: str, script: str,
                     changes: list[str], at=None) -> DataFrame:
    """One lineage row: version, time, source, script, change list, rows,
    columns.  The counts are one aggregate over the dataset."""
    t = F.current_timestamp() if at is None else F.lit(at)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(version).alias("version"), t.alias("created_at"), F.lit(source).alias("source"),
        F.lit(script).alias("script"),
        F.array(*[F.lit(c) for c in changes]).cast("array<string>").alias("changes"),
        F.col("rows"), F.lit(len(df.columns)).alias("columns"))


def append_rows(df: DataFrame, path: str) -> None:
    """Append-only table (manifest, model registry, deployments)."""
    df.write.mode("append").parquet(path)


# ---------------------------------------------------------------- K6
def registry_row(spark: SparkSession, model: str, data: str, accuracy: float, at=None) -> DataFrame:
    t = F.current_timestamp() if at is None else F.lit(at)
    return spark.range(1).select(F.lit(model).alias("model"), F.lit(data).alias("data"),
                                 F.lit(float(accuracy)).alias("accuracy"), t.alias("trained_at"))


def latest_model(registry: DataFrame) -> DataFrame:
    """The last trained model; of several at one time the last name."""
    return registry.agg(F.max_by("model", F.struct("trained_at", "model")).alias("model"),
                        F.max("trained_at").alias("trained_at"))


# ---------------------------------------------------------------- K7 / K8
def insert_or_ignore(target: DataFrame, batch: DataFrame, key: str,
                     order: list[str], id_col: str | None = "id") -> DataFrame:
    """Rows of ``batch`` to append to ``target`` under a UNIQUE ``key``.

    The first write wins: within the batch the first row per key in ``order``
    is kept, and keys already stored are skipped (anti join, plain equality:
    NULL keys never collide, so every NULL-key row is inserted, as a SQL
    UNIQUE constraint allows).  New ids continue after the stored maximum,
    in ``order``.  Returns the rows to append.
    """
    from tablekit.operators.aggs import key_dedup
    from tablekit.operators.splits import group_rank
    k = F.col(key)
    # first row per key in ``order``: a grouped min (partial aggregation, so a
    # key repeated in a third of the batch is reduced in every task)
    firsts = key_dedup(batch.filter(k.isNotNull()), [key], order_by=order)
    fresh = firsts.unionByName(batch.filter(k.isNull()))
    new = fresh.join(target.select(key).filter(k.isNotNull()), on=key, how="left_anti")
    if id_col is None:
        return new
    base = target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_base"))
    # ids: base + exact rank of the new rows in ``order`` (range-partitioned
    # rank, never a single-task window)
    ranked = group_rank(new, order, name="_r")
    return ranked.crossJoin(base).withColumn(id_col, F.col("_base") + F.col("_r")).drop(
        "_base", "_r")


def ensure_table(spark: SparkSession, name: str, schema: str, path: str) -> None:
    """CREATE TABLE IF NOT EXISTS (idempotent)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{path}'")


# ---------------------------------------------------------------- K9
def page_content(pages: DataFrame, url: str = "url", html: str = "html",
                 folder: str = "/data/scraped") -> DataFrame:
    """One table of (html_path, html) instead of one file per page."""
    return pages.select(url_to_file_name(F.col(url), folder).alias("html_path"), F.col(html))


CRAWL_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html_path", T.StringType()), T.StructField("images", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("scraped_at", T.StringType())])
