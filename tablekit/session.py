"""Session helpers: build a session with sane defaults and find shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tablekit") -> SparkSession:
    """Session for tests, benches and scripts.

    On a cluster the master, memory and partition settings come from
    ``spark-submit``; only pass them here for local runs.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # long base64 text must not be broken into lines
        "spark.sql.chunkBase64String.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint folder.

    The cluster names its shared folder in ``spark.checkpoint.dir``; it is
    read from the session.  Only when neither the setting nor the context's
    checkpoint folder exists (local tests) a private temporary folder is made
    and registered with ``setCheckpointDir`` (a core setting cannot be
    changed through ``spark.conf`` at run time).
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tablekit-ckpt-"))
        base = sc.getCheckpointDir()
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable, in the session's folder."""
    base = shared_dir(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh unique path in the shared folder, for intermediate tables."""
    return shared_dir(spark, "tablekit", f"{name}-{uuid.uuid4().hex[:12]}")


def local_scratch() -> str:
    """Fresh local folder, for tests and the bench only (never on a cluster)."""
    return tempfile.mkdtemp(prefix="tablekit-", dir=os.environ.get("TMPDIR", "/tmp"))
