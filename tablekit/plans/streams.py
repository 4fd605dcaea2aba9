"""Registered queries: Structured Streaming replays of the driver's tables
(S9, S10, R1-R7, R9-R13).  Each query stages files derived from a table,
streams them with an ``availableNow`` trigger, and returns the sink read back
as a batch table, so the stream must equal the batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.operators.aggs import LATENCY_BUCKETS
from tablekit.operators.series import epoch_us, from_epoch_us, histogram_quantile_expr
from tablekit.plans import series as SER
from tablekit.registry import query, table
from tablekit.sources.keyed import UniqueTable
from tablekit.streaming import streams as ST

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def staged_events(spark: SparkSession, sf_dir: str, name: str, parts: int = 6) -> dict:
    dirs = ST.stream_dirs(spark, name)
    ST.stage_files(table(spark, sf_dir, "events"), dirs["source"], parts, "ts")
    return dirs


@query("stream_counters", sql="SELECT event_type, user_id, count(*) AS total FROM events GROUP BY ALL")
def q_stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals per label set, each batch writing the sets it
    changed, equal to G17."""
    dirs = staged_events(spark, sf_dir, "counters")
    src = ST.file_stream(spark, dirs["source"], EVENTS, max_files=2)
    ST.run_available_now(ST.stream_counters(src, ["event_type", "user_id"]), dirs["checkpoint"],
                         "update", path=dirs["sink"])
    # a restart from the checkpoint with no new files runs no batch and
    # leaves the result as it is
    ST.run_available_now(ST.stream_counters(ST.file_stream(spark, dirs["source"], EVENTS),
                                            ["event_type", "user_id"]),
                         dirs["checkpoint"], "update", path=dirs["sink"])
    return ST.read_latest(spark, dirs["sink"], ["event_type", "user_id"])


@query("file_arrival_source", sql="""
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type""")
def q_file_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files arriving in a folder, picked up by a file stream."""
    dirs = ST.stream_dirs(spark, "csv_arrival")
    (table(spark, sf_dir, "events").repartitionByRange(4, "ts")
        .write.option("header", True).csv(dirs["source"]))
    src = ST.file_stream(spark, dirs["source"], EVENTS, fmt="csv", max_files=1, header=True)
    agg = src.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                        F.round(F.sum("value"), 4).alias("total"))
    ST.run_available_now(agg, dirs["checkpoint"], "complete", path=dirs["sink"])
    return ST.read_sink(spark, dirs["sink"])


@query("metric_sample_source", sql="""
SELECT 'events' AS job, CAST(user_id AS VARCHAR) AS instance, event_type AS metric, ts, value
FROM events""")
def q_metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled samples (job, instance, metric, labels, ts, value) from
    a stream of sample files."""
    dirs = staged_events(spark, sf_dir, "samples")
    src = ST.file_stream(spark, dirs["source"], EVENTS, max_files=3)
    samples = src.select(F.lit("events").alias("job"), F.col("user_id").cast("string").alias("instance"),
                         F.col("event_type").alias("metric"),
                         F.create_map(F.lit("event_type"), F.col("event_type")).alias("labels"),
                         "ts", "value")
    ST.run_available_now(samples, dirs["checkpoint"], "append", path=dirs["sink"])
    return ST.read_sink(spark, dirs["sink"]).drop("labels")


def _windowed(spark, sf_dir, name, size, slide, aggs, post=None):
    dirs = staged_events(spark, sf_dir, name)

    def build(src):
        w = ST.stream_windows(src, "ts", ["event_type"], size, slide, "1 hour", aggs)
        return post(w) if post else w
    ST.replay(spark, build, dirs, EVENTS, "append", "ts", "user_id")
    # the late sentinel must reach the watermark, so its own windows are
    # dropped only here, by their time (rows without an event type are real):
    # a filter inside the stream would be pushed below the watermark
    out = ST.read_sink(spark, dirs["sink"])
    end = "window_end" if "window_end" in out.columns else "t"
    return out.filter(from_epoch_us(F.lit(ST.SENTINEL_US)) > F.col(end))


@query("stream_tumbling", sql="""
SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n, round(sum(value), 4) AS total
FROM events GROUP BY ALL""")
def q_stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: one value per evaluation step (1 h tumbling windows, watermark)."""
    return _windowed(spark, sf_dir, "tumbling", "1 hour", None,
                     [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")])


_SLIDE_SQL = """w AS (
  SELECT event_type, value / 10 AS lat,
         (epoch_us(ts) // 3600000000 + unnest(range(1, 7))) * 3600000000 AS e FROM events)"""


@query("stream_sliding_rate", sql=f"""WITH {_SLIDE_SQL}
SELECT event_type, make_timestamp(e - 21600000000) AS window_start, make_timestamp(e) AS window_end,
       count(*) AS n, round(count(*) / 21600.0, 8) AS rate
FROM w GROUP BY ALL""")
def q_stream_sliding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per second over 6 h windows sliding by 1 h."""
    return _windowed(spark, sf_dir, "sliding", "6 hours", "1 hour",
                     [F.count(F.lit(1)).alias("n"),
                      F.round(F.count(F.lit(1)) / 21600.0, 8).alias("rate")])


def _quantile_post(w: DataFrame) -> DataFrame:
    cum = [F.col(f"c{i}") for i in range(len(LATENCY_BUCKETS))]
    return w.select("event_type", "window_start", "window_end",
                    F.round(histogram_quantile_expr(0.95, LATENCY_BUCKETS, cum, F.col("cinf")), 6)
                    .alias("q95"))


def _q_aggs():
    return ([F.count_if(F.col("value") / 10 <= float(b)).alias(f"c{i}")
             for i, b in enumerate(LATENCY_BUCKETS)] + [F.count(F.lit(1)).alias("cinf")])


@query("stream_quantile", sql=f"""WITH {_SLIDE_SQL},
c AS (SELECT event_type, e, {", ".join(f"count(*) FILTER (WHERE lat <= {float(b)}) AS c{i}"
                                       for i, b in enumerate(LATENCY_BUCKETS))}, count(*) AS cinf
      FROM w GROUP BY ALL)
SELECT event_type, make_timestamp(e - 21600000000) AS window_start, make_timestamp(e) AS window_end,
       round({SER._quantile_sql(0.95, LATENCY_BUCKETS)}, 6) AS q95
FROM c""")
def q_stream_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p95 latency from bucket counts inside each sliding window."""
    return _windowed(spark, sf_dir, "quantile", "6 hours", "1 hour", _q_aggs(), _quantile_post)


@query("stream_recording", sql=f"""WITH {_SLIDE_SQL},
c AS (SELECT event_type, e, {", ".join(f"count(*) FILTER (WHERE lat <= {float(b)}) AS c{i}"
                                       for i, b in enumerate(LATENCY_BUCKETS))}, count(*) AS cinf
      FROM w GROUP BY ALL)
SELECT 'job:captioning_inference_latency:p95' AS name, event_type, make_timestamp(e) AS t,
       round({SER._quantile_sql(0.95, LATENCY_BUCKETS)}, 6) AS value
FROM c""")
def q_stream_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The p95 series stored under a recorded name (append sink with a
    checkpoint)."""
    def post(w):
        q = _quantile_post(w)
        return q.select(F.lit("job:captioning_inference_latency:p95").alias("name"), "event_type",
                        F.col("window_end").alias("t"), F.col("q95").alias("value"))
    return _windowed(spark, sf_dir, "recording", "6 hours", "1 hour", _q_aggs(), post)


COND = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("t", T.TimestampNTZType())])


@query("stream_alert_state", sql=f"WITH {SER._alerts_sql('HighErrorRate')} SELECT * FROM a")
def q_stream_alert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending / firing / resolved per instance with event-time timers
    over the stream of true-condition grid samples; equals the batch W9."""
    etype, limit = SER.ALERT_DEFS["HighErrorRate"]
    from tablekit.operators.series import sliding_totals
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    g = sliding_totals(ev, ["user_id"], "ts", SER.STEP_S, SER.RANGE_S,
                       {"n": F.when(F.col("event_type").isNotNull(), 1).otherwise(0).cast("long"),
                        "hits": F.when(F.col("event_type") == etype, 1).otherwise(0).cast("long")})
    cond = g.filter((F.col("n") >= 1) & (F.col("hits") / F.col("n") > limit)).select("user_id", "t")
    dirs = ST.stream_dirs(spark, "alert_state")
    ST.stage_files(cond, dirs["source"], 4, "t")

    def build(src):
        return ST.stream_alert_state(src, "user_id", "t", SER.STEP_S, SER.FOR_S)
    ST.replay(spark, build, dirs, COND, "append", "t", "user_id", store=ST.STATE_STORE)
    out = ST.read_sink(spark, dirs["sink"]).filter(F.col("pending_us") < ST.SENTINEL_US)
    return out.select(F.col("instance").alias("user_id"), F.lit("HighErrorRate").alias("alertname"),
                      from_epoch_us(F.col("pending_us")).alias("pending_at"),
                      from_epoch_us(F.col("firing_us")).alias("firing_at"),
                      from_epoch_us(F.col("resolved_us")).alias("resolved_at"))


@query("stream_no_data", sql="""
SELECT user_id, ts AS silent_from, nts AS silent_to FROM (
  SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts,
         max(ts) OVER () AS upto FROM events)
WHERE epoch_us(coalesce(nts, upto)) - epoch_us(ts) > 43200000000""")
def q_stream_no_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silences longer than 12 h per user, from files in no order, so the
    watermark spans the table.  A silence open at the table's last event has
    no end."""
    dirs = ST.stream_dirs(spark, "no_data")
    ev = table(spark, sf_dir, "events")
    ST.stage_files(ev.select("user_id", "ts"), dirs["source"], 3)
    first, upto = ev.agg(F.min(epoch_us("ts")), F.max(epoch_us("ts"))).first()
    span = f"{(upto - first) // 1_000_000 + 1} seconds" if upto is not None else "1 day"

    def build(src):
        return ST.stream_no_data(src, "user_id", "ts", 43200, span)
    schema = T.StructType([EVENTS["user_id"], EVENTS["ts"]])
    # one file a batch first; then the sentinel lets the open silences ripen
    ST.run_available_now(build(ST.file_stream(spark, dirs["source"], schema, max_files=1)),
                         dirs["checkpoint"], "append", path=dirs["sink"], store=ST.STATE_STORE)
    ST.replay(spark, build, dirs, schema, "append", "ts", "user_id", store=ST.STATE_STORE)
    out = (ST.read_sink(spark, dirs["sink"]).filter(F.col("from_us") < ST.SENTINEL_US)
             .groupBy("user_id", "from_us").agg(F.max("to_us").alias("to_us")))
    out = out.filter(F.coalesce("to_us", F.lit(upto)) - F.col("from_us") > 43_200_000_000)
    return out.select("user_id", from_epoch_us(F.col("from_us")).alias("silent_from"),
                      from_epoch_us(F.col("to_us")).alias("silent_to"))


@query("stream_first_wins", sql="""
WITH a AS (SELECT page_id, url FROM pages WHERE url NOT LIKE 'https%'),
b AS (SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM a))
SELECT row_number() OVER (ORDER BY page_id) AS id, url, 'failed' AS status FROM a
UNION ALL
SELECT (SELECT count(*) FROM a) + row_number() OVER (ORDER BY page_id), url, 'success' FROM b""")
def q_stream_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-or-ignore across runs: run 1 stores the failed http
    fetches; run 2 brings every page again and only new URLs are inserted."""
    dirs = ST.stream_dirs(spark, "first_wins")
    pages = table(spark, sf_dir, "pages")
    run1 = pages.filter(~F.col("url").startswith("https")).select(
        "page_id", "url", F.lit("failed").alias("status"))
    run2 = pages.select("page_id", "url", F.when(F.col("url").startswith("https"), "success")
                        .otherwise("failed").alias("status"))
    schema = run1.schema
    run1.coalesce(2).write.mode("append").parquet(dirs["source"] + "/run=1")
    sink = ST.first_wins_sink(dirs["sink"], "url", ["page_id"], "crawl")
    opts = {"recursiveFileLookup": True}
    ST.run_available_now(ST.file_stream(spark, dirs["source"], schema, **opts), dirs["checkpoint"],
                         "append", sink=sink)
    run2.coalesce(2).write.mode("append").parquet(dirs["source"] + "/run=2")
    ST.run_available_now(ST.file_stream(spark, dirs["source"], schema, **opts), dirs["checkpoint"],
                         "append", sink=sink)
    return UniqueTable(spark, dirs["sink"], "url", ["page_id"]).read().select("id", "url", "status")


@query("stream_validate", sql=r"""
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN text IS NULL OR regexp_replace(text, '\s', '', 'g') = ''
              THEN 'quarantine' ELSE 'valid' END AS outcome FROM conversations)
GROUP BY outcome""")
def q_stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation on a stream with a quarantine sink (two writes per
    batch)."""
    dirs = ST.stream_dirs(spark, "validate")
    conv = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("body"))
    ST.stage_files(conv, dirs["source"], 3, "conv_id")
    valid, bad = dirs["sink"] + "/valid", dirs["sink"] + "/quarantine"
    ST.run_available_now(ST.file_stream(spark, dirs["source"], conv.schema, max_files=1),
                         dirs["checkpoint"], "append", sink=ST.validate_sink(valid, bad, "body"))
    v = ST.read_sink(spark, valid).select(F.lit("valid").alias("outcome"))
    q = ST.read_sink(spark, bad).select(F.lit("quarantine").alias("outcome"))
    return v.unionByName(q).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("stream_threshold_notify")
def q_stream_threshold_notify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running success count over crawl runs; one notice when it first
    reaches the limit (``once``)."""
    dirs = ST.stream_dirs(spark, "notify")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.when(F.col("url").startswith("https"), "success").otherwise("failed").alias("status"))
    ST.stage_files(pages, dirs["source"], 3, "page_id")
    src = ST.file_stream(spark, dirs["source"], pages.schema, max_files=1)
    counts = src.agg(F.count_if(F.col("status") == "success").alias("count"))
    ST.run_available_now(counts, dirs["checkpoint"], "complete",
                         sink=ST.threshold_notify_sink(dirs["sink"], 2, once=True))
    return ST.read_sink(spark, dirs["sink"])


@query("stream_score")
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving part rows scored by the stored forest pipeline."""
    from tablekit.plans.ml import _forest, part_frame
    from tablekit.operators.mlops import model_store
    from tablekit.registry import scratch_dir_for
    model, _, _ = _forest(spark, sf_dir)
    model = model_store(model, scratch_dir_for(spark, "stream_model"))
    dirs = ST.stream_dirs(spark, "score")
    rows = part_frame(spark, sf_dir)
    ST.stage_files(rows, dirs["source"], 3, "p_partkey")
    src = ST.file_stream(spark, dirs["source"], rows.schema, max_files=1)
    scored = model.transform(src).select("p_partkey", "label",
                                         F.col("prediction").cast("int").alias("prediction"))
    ST.run_available_now(scored, dirs["checkpoint"], "append", path=dirs["sink"])
    return ST.read_sink(spark, dirs["sink"])


ALERTS = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("kind", T.StringType()),
                       T.StructField("pending_at", T.TimestampNTZType()),
                       T.StructField("firing_at", T.TimestampNTZType()),
                       T.StructField("resolved_at", T.TimestampNTZType())])


@query("stream_inhibit", sql=f"""WITH {SER._alerts_sql('SlowInference', '_t')},
{SER._alerts_sql('HighErrorRate', '_s')}
SELECT * FROM a_t t WHERE NOT EXISTS (
  SELECT 1 FROM a_s s WHERE s.user_id = t.user_id
    AND t.firing_at < s.resolved_at AND t.resolved_at > s.firing_at)""")
def q_stream_inhibit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 on live alerts (state rows per instance and time bucket), equal
    to the batch J4."""
    cols = ["user_id", "pending_at", "firing_at", "resolved_at"]
    tgt = SER.share_alerts(spark, sf_dir, "SlowInference").select(*cols).withColumn("kind", F.lit("target"))
    src = SER.share_alerts(spark, sf_dir, "HighErrorRate").select(*cols).withColumn("kind", F.lit("source"))
    dirs = ST.stream_dirs(spark, "inhibit")
    ST.stage_files(tgt.unionByName(src).select(*ALERTS.names), dirs["source"], 4, "firing_at")

    def build(s):
        return ST.stream_inhibit(s.withColumn("firing_at", F.coalesce("firing_at", "pending_at"))
                                 .withColumn("resolved_at", F.coalesce("resolved_at", "firing_at"))
                                 .withColumn("pending_at", F.coalesce("pending_at", "firing_at"))
                                 .withColumn("kind", F.coalesce("kind", F.lit("source"))), "user_id")
    ST.replay(spark, build, dirs, ALERTS, "append", "pending_at", "user_id", store=ST.STATE_STORE)
    out = ST.read_sink(spark, dirs["sink"]).filter(F.col("pending_us") < ST.SENTINEL_US)
    return out.select(F.col("instance").alias("user_id"), F.lit("SlowInference").alias("alertname"),
                      from_epoch_us(F.col("pending_us")).alias("pending_at"),
                      from_epoch_us(F.col("firing_us")).alias("firing_at"),
                      from_epoch_us(F.col("resolved_us")).alias("resolved_at"))
