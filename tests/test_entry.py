"""Driver contract: entry smoke, registry consistency, a cross-section of
queries against their SQL twins on DuckDB, and the small sinks/sources."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tablekit.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import check, duck

SAMPLE = ["trip_cleanse", "stage_funnel", "key_dedup", "broadcast_left_join", "classification_report",
          "per_model_results", "counter_rate", "histogram_quantile", "alert_intervals",
          "inhibit_anti_join", "stratified_split", "weighted_resample", "extract_links",
          "entities_to_struct", "insert_or_ignore", "dataset_fingerprint", "stream_tumbling",
          "stream_alert_state", "standardize", "round_digits", "early_stop", "inflight_gauge"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    assert df.count() >= 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(QUERIES) >= 130 and set(QUERIES) <= set(q)
    for k in QUERIES:
        assert not k.startswith("op") and "pipeline" not in k


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", SAMPLE)
def test_sql_twin(spark, con, key):
    line = check(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF_SMALL)
    assert line.startswith("OK"), line


def test_json_sink_and_documents(spark, tmp_dir):
    from tablekit.sources.files import scan_json_documents
    from tablekit.sources.sinks import sink_json
    hist = [{"epoch": 1, "train_loss": 0.9, "val_loss": 1.0}, {"epoch": 2, "train_loss": 0.5, "val_loss": 0.7}]
    with open(f"{tmp_dir}/history.json", "w") as f:
        json.dump(hist, f, indent=2)
    with open(f"{tmp_dir}/stages.json", "w") as f:
        json.dump({"epoch": 9, "train_loss": 0.1, "val_loss": 0.2}, f, indent=2)
    df = scan_json_documents(spark, tmp_dir, "epoch int, train_loss double, val_loss double")
    assert sorted(r["epoch"] for r in df.collect()) == [1, 2, 9]
    sink_json(df.agg(F.max("val_loss").alias("best")), f"{tmp_dir}/out")
    back = spark.read.json(f"{tmp_dir}/out")
    assert back.first()["best"] == 1.0


def test_registry_and_manifest_append(spark, tmp_dir):
    import datetime as dt
    from tablekit.sources.sinks import append_rows, dataset_manifest, latest_model, registry_row
    t0 = dt.datetime(2024, 1, 1)
    append_rows(registry_row(spark, "forest_v1", "v1", 0.99, at=t0), f"{tmp_dir}/reg")
    append_rows(registry_row(spark, "forest_v2", "v2", 0.98, at=t0 + dt.timedelta(days=1)), f"{tmp_dir}/reg")
    assert latest_model(spark.read.parquet(f"{tmp_dir}/reg")).first()["model"] == "forest_v2"
    m = dataset_manifest(spark.range(7).withColumn("x", F.lit(1)), "v1", "src", "prep", ["a", "b"], at=t0)
    r = m.first()
    assert (r["rows"], r["columns"], r["changes"]) == (7, 2, ["a", "b"])


def test_ensure_table_idempotent(spark, tmp_dir):
    from tablekit.sources.sinks import ensure_table
    for _ in range(2):
        ensure_table(spark, "tk_pages", "id BIGINT, url STRING", f"{tmp_dir}/pages")
    assert spark.table("tk_pages").columns == ["id", "url"]
    spark.sql("DROP TABLE tk_pages")


def test_iso_time_format(spark):
    import datetime as dt
    from tablekit.functions.scalars import iso_time
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 6),)], "t timestamp_ntz")
    assert df.select(iso_time(F.col("t"))).first()[0] == "2024-01-02T03:04:05.000006"


def test_stream_restart_adds_nothing(spark):
    from tablekit.plans.streams import EVENTS, staged_events
    from tablekit.streaming import streams as ST
    dirs = staged_events(spark, SF_SMALL, "restart")
    agg = lambda: ST.stream_counters(ST.file_stream(spark, dirs["source"], EVENTS), ["event_type"])  # noqa
    ST.run_available_now(agg(), dirs["checkpoint"], "complete", path=dirs["sink"])
    first = sorted(map(tuple, ST.read_sink(spark, dirs["sink"]).collect()))
    ST.run_available_now(agg(), dirs["checkpoint"], "complete", path=dirs["sink"])
    assert sorted(map(tuple, ST.read_sink(spark, dirs["sink"]).collect())) == first
    assert os.path.isdir(dirs["checkpoint"])


def test_parquet_dir_missing_raises(spark, tmp_dir):
    from tablekit.sources.files import scan_parquet_dir
    with pytest.raises(Exception):
        scan_parquet_dir(spark, f"{tmp_dir}/nothing").count()
