"""Registered queries: metric time series and alerts from ``events``
(W4-W10, J3, J4, J9, G21, M9, M10).

Stand-ins (FIXTURES.md §3): a counter sample is the running count of events
per (user_id, event_type) within a day (it restarts each day: a counter
reset); latency seconds = value / 10; an instance is a user.  Events lie
minutes apart, so the queries use 6 h ranges and 1 h steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions.scalars import iso_time
from tablekit.operators import series as TS
from tablekit.operators.aggs import LATENCY_BUCKETS, avg_by
from tablekit.operators.joins import alert_enrich, inhibit, vector_arith
from tablekit.operators.rules import AlertRule, RangeSum, range_segments, range_sums, routed_alerts, rule_intervals
from tablekit.operators.splits import group_rank
from tablekit.registry import ORACLE, query, scratch_dir_for, table
from tablekit.sources.keyed import AppendLog
from tablekit.sources.sinks import latest_model, sink_json

RANGE_S = 6 * 3600
STEP_S = 3600
FOR_S = 2 * 3600
W_US = RANGE_S * 1_000_000
S_US = STEP_S * 1_000_000

# Alert rule metadata (name, severity, summary, description).
ALERT_RULES = [
    ("AppDown", "critical", "no events", "A user sent nothing for a whole interval."),
    ("HighErrorRate", "critical", "many error events",
     "Error events are over 30 percent of the events of a user within 6 hours."),
    ("SlowInference", "warning", "many purchase events",
     "Purchase events are over 30 percent of the events of a user within 6 hours."),
]
# stand-in conditions: share of one event type among a user's events over 6 h
ALERT_DEFS = {"HighErrorRate": ("error", 0.3), "SlowInference": ("purchase", 0.3)}


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    r = group_rank(ev.select("user_id", "event_type", "day", "ts", "event_id"), ["ts", "event_id"],
                   group=["user_id", "event_type", "day"], name="value", materialize=False)
    return r.select("user_id", "event_type", "ts", F.col("value").cast("double").alias("value"))


_COUNTER_SQL = f"""
s AS (SELECT user_id, event_type, epoch_us(ts) AS us,
             row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                ORDER BY ts, event_id) AS value
      FROM events),
d AS (SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN 0.0
                     WHEN value < lag(value) OVER w THEN value
                     ELSE value - lag(value) OVER w END AS delta
      FROM s WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us)),
g AS (SELECT user_id, event_type,
             unnest(generate_series(CAST(ceil(lo / {S_US}) AS BIGINT),
                                    CAST(floor((hi + {W_US} - 1) / {S_US}) AS BIGINT))) * {S_US} AS t
      FROM (SELECT user_id, event_type, min(us) AS lo, max(us) AS hi FROM d GROUP BY ALL)),
f AS (SELECT g.user_id, g.event_type, g.t, count(*) AS n, sum(d.delta) AS s,
             arg_min(d.delta, d.us) AS f
      FROM g JOIN d ON d.user_id = g.user_id AND d.event_type = g.event_type
                   AND d.us > g.t - {W_US} AND d.us <= g.t
      GROUP BY ALL),
rates AS (SELECT user_id, event_type, t, (s - f) / {RANGE_S} AS rate FROM f WHERE n >= 2)"""


@query("counter_rate", sql=f"""WITH {_COUNTER_SQL}
SELECT user_id, event_type, make_timestamp(t) AS t, round(rate, 8) AS rate FROM rates""")
def q_counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate over 6 h of the daily-reset event counters, hourly grid."""
    r = TS.counter_rate(counter_samples(spark, sf_dir), ["user_id", "event_type"], "ts", "value",
                        RANGE_S, STEP_S)
    return r.withColumn("rate", F.round("rate", 8))


@query("avg_by_instance", sql=f"""WITH {_COUNTER_SQL}
SELECT user_id, make_timestamp(t) AS t, round(avg(rate), 8) AS rate FROM rates GROUP BY ALL""")
def q_avg_by_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the counter rates over event types per (user, t)."""
    r = TS.counter_rate(counter_samples(spark, sf_dir), ["user_id", "event_type"], "ts", "value",
                        RANGE_S, STEP_S)
    return avg_by(r, ["user_id", "t"], "rate").withColumn("rate", F.round("rate", 8))


def _grid_sql(series: str, src: str, cols: str, sfx: str = "") -> str:
    """Frames (t - range, t] on the hourly grid for samples in ``src``; CTEs
    g{sfx} (grid) and f{sfx} (frames)."""
    keys = [c.strip() for c in series.split(",")]
    return f"""
g{sfx} AS (SELECT {series}, unnest(generate_series(CAST(ceil(lo / {S_US}) AS BIGINT),
              CAST(floor((hi + {W_US} - 1) / {S_US}) AS BIGINT))) * {S_US} AS t
      FROM (SELECT {series}, min(us) AS lo, max(us) AS hi FROM {src} GROUP BY ALL)),
f{sfx} AS (SELECT {", ".join("gg." + c for c in keys)}, gg.t, {cols}
      FROM g{sfx} gg JOIN {src} x ON {" AND ".join(f"x.{c} = gg.{c}" for c in keys)}
                   AND x.us > gg.t - {W_US} AND x.us <= gg.t
      GROUP BY ALL)"""


def _quantile_sql(q: float, bounds: list[float]) -> str:
    parts = []
    for i, ub in enumerate(bounds):
        lb = 0.0 if i == 0 else float(bounds[i - 1])
        prev = "0.0" if i == 0 else f"c{i - 1}"
        rank = f"({q} * cinf)"
        val = (f"{lb} + ({float(ub)} - {lb}) * coalesce(({rank} - {prev}) / "
               f"nullif(c{i} - {prev}, 0), 0.0)")
        parts.append(f"WHEN c{i} >= {rank} THEN {val}")
    return f"CASE WHEN cinf > 0 THEN CASE {' '.join(parts)} ELSE {float(bounds[-1])} END END"


_HQ_COLS = ", ".join(f"count(*) FILTER (WHERE x.lat <= {float(b)}) AS c{i}"
                     for i, b in enumerate(LATENCY_BUCKETS)) + ", count(*) AS cinf"


@query("histogram_quantile", sql=f"""WITH
e AS (SELECT event_type, epoch_us(ts) AS us, value / 10 AS lat FROM events),
{_grid_sql("event_type", "e", _HQ_COLS)}
SELECT event_type, make_timestamp(t) AS t, round(cinf / {RANGE_S}, 8) AS count_rate,
       round({_quantile_sql(0.95, LATENCY_BUCKETS)}, 6) AS q95,
       round({_quantile_sql(0.5, LATENCY_BUCKETS)}, 6) AS q50
FROM f""")
def q_histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + recording rules p95 / p50: latency quantiles over 6 h per event
    type from the fixed latency buckets (+Inf crossing gives 30)."""
    ev = table(spark, sf_dir, "events").select("event_type", "ts", (F.col("value") / 10).alias("lat"))
    h = TS.sliding_histogram_quantile(ev, ["event_type"], "ts", "lat", LATENCY_BUCKETS,
                                      [0.95, 0.5], RANGE_S, STEP_S)
    return h.select("event_type", "t", F.round("count_rate", 8).alias("count_rate"),
                    F.round("q95", 6).alias("q95"), F.round("q50", 6).alias("q50"))


def share_alerts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    etype, limit = ALERT_DEFS[name]
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    sums = {"n": F.when(F.col("event_type").isNotNull(), 1).otherwise(0).cast("long"),
            "hits": F.when(F.col("event_type") == etype, 1).otherwise(0).cast("long")}
    g = TS.sliding_totals(ev, ["user_id"], "ts", STEP_S, RANGE_S, sums)
    cond = g.filter((F.col("n") >= 1) & (F.col("hits") / F.col("n") > limit))
    return TS.alert_intervals(cond, ["user_id"], STEP_S, FOR_S, name)


def _alerts_sql(name: str, sfx: str = "") -> str:
    """CTE chain ending in a{sfx}: intervals of one share alert."""
    etype, limit = ALERT_DEFS[name]
    hits = f"count(*) AS n, count(*) FILTER (WHERE x.event_type = '{etype}') AS hits"
    return f"""
e{sfx} AS (SELECT user_id, epoch_us(ts) AS us, event_type FROM events),
{_grid_sql("user_id", "e" + sfx, hits, sfx)},
c{sfx} AS (SELECT user_id, t FROM f{sfx} WHERE hits / n > {limit}),
i{sfx} AS (SELECT user_id, t, t // {S_US} - row_number() OVER (PARTITION BY user_id ORDER BY t) AS isl
          FROM c{sfx}),
isl{sfx} AS (SELECT user_id, min(t) AS s, max(t) AS e FROM i{sfx} GROUP BY user_id, isl),
a{sfx} AS (SELECT user_id, '{name}' AS alertname, make_timestamp(s) AS pending_at,
             make_timestamp(s + {FOR_S * 1_000_000}) AS firing_at,
             make_timestamp(e + {S_US}) AS resolved_at
      FROM isl{sfx} WHERE e - s >= {FOR_S * 1_000_000})"""


@query("alert_intervals", sql=f"WITH {_alerts_sql('HighErrorRate')} SELECT * FROM a")
def q_alert_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error share over 6 h above 0.3 for 2 h fires (gaps and islands)."""
    return share_alerts(spark, sf_dir, "HighErrorRate")


@query("inhibit_anti_join", sql=f"""WITH {_alerts_sql('SlowInference', '_t')},
{_alerts_sql('HighErrorRate', '_s')}
SELECT * FROM a_t t WHERE NOT EXISTS (
  SELECT 1 FROM a_s s WHERE s.user_id = t.user_id
    AND t.firing_at < s.resolved_at AND t.resolved_at > s.firing_at)""")
def q_inhibit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SlowInference stand-in alerts suppressed while the error alert
    fires on the same instance (firing intervals overlap)."""
    tgt = share_alerts(spark, sf_dir, "SlowInference")
    src = share_alerts(spark, sf_dir, "HighErrorRate")
    return inhibit(tgt, src, ["user_id"], start="firing_at", end="resolved_at")


_RULES_SQL = "(VALUES " + ", ".join(
    "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in ALERT_RULES
) + ") r(alertname, severity, summary, description)"


@query("alert_enrich", sql=f"""WITH {_alerts_sql('HighErrorRate')}
SELECT a.*, r.severity, r.summary, r.description FROM a LEFT JOIN {_RULES_SQL} USING (alertname)""")
def q_alert_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity and annotations of the rule attached to each alert."""
    rules = spark.createDataFrame(ALERT_RULES, "alertname string, severity string, summary string, "
                                               "description string")
    return alert_enrich(share_alerts(spark, sf_dir, "HighErrorRate"), rules)


@query("liveness_gaps", sql="""
SELECT user_id, ts AS silent_from, nts AS silent_to, (epoch_us(nts) - epoch_us(ts)) // 1000000 AS gap_s
FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts FROM events)
WHERE (epoch_us(nts) - epoch_us(ts)) // 1000000 > 43200""")
def q_liveness_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W10 / R10 batch form: users silent for more than 12 h."""
    ev = table(spark, sf_dir, "events")
    return TS.liveness_gaps(ev, ["user_id"], "ts", 43200, "event_id")


@query("inflight_gauge", sql="""
WITH x AS (
  SELECT event_type, event_id, ts AS at_time, 1 AS delta, 1 AS o FROM events
  UNION ALL
  SELECT event_type, event_id, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)), -1, 0
  FROM events)
SELECT event_type, event_id, at_time, delta,
       CAST(sum(delta) OVER (PARTITION BY event_type ORDER BY at_time, o, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS in_flight
FROM x""")
def q_inflight_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in flight per event type; a request lasts ``value``
    seconds."""
    ev = table(spark, sf_dir, "events").select(
        "event_type", "event_id", F.col("ts").alias("start"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))).alias("end"))
    g = TS.inflight_gauge(ev, ["event_type"], "start", "end", "event_id")
    return g.select("event_type", "event_id", "at_time", "delta", F.col("in_flight").cast("long"))


@query("latest_value", sql="""
SELECT user_id, arg_max(value, ts) AS last_value, max(ts) AS last_ts FROM events
WHERE value IS NOT NULL GROUP BY user_id""")
def q_latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TS.latest_value(table(spark, sf_dir, "events"), ["user_id"], "ts", "value")


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run (event type) and epoch (day of month): metric rows."""
    ev = table(spark, sf_dir, "events")
    d = ev.groupBy(F.col("event_type").alias("run"), F.dayofmonth("ts").alias("epoch")).agg(
        F.round(F.avg("value"), 6).alias("mean_value"), F.round(F.max("value"), 6).alias("max_value"))
    return d.selectExpr("run", "epoch", "stack(2, 'mean_value', mean_value, 'max_value', max_value) "
                        "AS (key, value)")


_HIST_SQL = """h AS (
  SELECT run, epoch, key, value FROM (
    SELECT event_type AS run, CAST(dayofmonth(ts) AS INTEGER) AS epoch,
           round(avg(value), 6) AS mean_value, round(max(value), 6) AS max_value
    FROM events GROUP BY ALL)
  UNPIVOT (value FOR key IN (mean_value, max_value)))"""


@query("metric_history", sql=f"WITH {_HIST_SQL} SELECT * FROM h")
def q_metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_history(spark, sf_dir)


@query("early_stop", sql=f"""WITH {_HIST_SQL},
m AS (SELECT run, epoch, value FROM h WHERE key = 'mean_value'),
p AS (SELECT *, min(value) OVER (PARTITION BY run ORDER BY epoch
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_prev FROM m),
q AS (SELECT *, best_prev IS NULL OR value < best_prev AS improved FROM p),
r AS (SELECT *, max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_improved FROM q),
st AS (SELECT run, min(epoch) AS stop_epoch FROM r WHERE epoch - last_improved >= 3 GROUP BY run),
seen AS (SELECT r.*, st.stop_epoch FROM r LEFT JOIN st USING (run)
         WHERE st.stop_epoch IS NULL OR r.epoch <= st.stop_epoch)
SELECT run, arg_min(epoch, (value, epoch)) AS best_epoch, min(value) AS best_value,
       max(epoch) AS last_epoch, max(stop_epoch) AS stop_epoch,
       max(stop_epoch) IS NOT NULL AS stopped_early
FROM seen GROUP BY run""")
def q_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patience 3 on the daily mean value read as a loss."""
    h = metric_history(spark, sf_dir).filter(F.col("key") == "mean_value")
    return TS.early_stop(h, "run", "epoch", "value", patience=3, mode="min")


@query("run_leaderboard", sql=f"""WITH {_HIST_SQL},
last AS (SELECT run, key, arg_max(value, epoch) AS value, max(epoch) AS last_epoch FROM h GROUP BY ALL)
SELECT run, max(last_epoch) AS last_epoch,
       max(value) FILTER (WHERE key = 'mean_value') AS mean_value,
       max(value) FILTER (WHERE key = 'max_value') AS max_value
FROM last GROUP BY run""")
def q_run_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: final metrics per run (last step per key), long to wide with the
    key list given; best (lowest mean) first."""
    h = metric_history(spark, sf_dir)
    last = TS.latest_value(h.withColumnRenamed("epoch", "step"), ["run", "key"], "step", "value")
    wide = (last.groupBy("run").pivot("key", ["mean_value", "max_value"])
                .agg(F.first("last_value")))
    steps = last.groupBy("run").agg(F.max("last_step").alias("last_epoch"))
    return wide.join(steps, "run").select("run", "last_epoch", "mean_value", "max_value") \
               .orderBy("mean_value")


@query("leaderboard", sql=f"""
SELECT run, l.last_epoch, e.best_epoch, e.best_value, e.stopped_early, l.mean_value, l.max_value
FROM ({ORACLE["early_stop"]}) e JOIN ({ORACLE["run_leaderboard"]}) l USING (run)""")
def q_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run its history, early stop and last values in one table, best
    run first."""
    stop = q_early_stop(spark, sf_dir).drop("last_epoch", "stop_epoch")
    last = q_run_leaderboard(spark, sf_dir)
    return last.join(stop, "run").select(
        "run", "last_epoch", "best_epoch", "best_value", "stopped_early", "mean_value",
        "max_value").orderBy("best_value", "run")


@query("sink_json", sql=f"""WITH {_HIST_SQL} SELECT run, epoch, key, value FROM h""")
def q_sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the metric history written as JSON and read back."""
    h, path = metric_history(spark, sf_dir), scratch_dir_for(spark, "history_json")
    sink_json(h, path)
    return spark.read.schema(h.schema).json(path)


@query("registry_append", sql="""
SELECT arg_max(event_type, (t, event_type)) AS model, max(t) AS trained_at
FROM (SELECT event_type, max(ts) AS t FROM events GROUP BY event_type)""")
def q_registry_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: two committed appends to a registry, then its latest model."""
    log = AppendLog(spark, scratch_dir_for(spark, "registry"))
    runs = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model")).agg(
        F.max("ts").alias("trained_at"), F.avg("value").alias("accuracy"))
    early = F.col("model") < "m"
    log.append(runs.filter(early))
    log.append(runs.filter(~early | F.col("model").isNull()))
    return latest_model(log.read())


@query("ingest_time", sql="""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM events""")
def q_ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO-8601 text of each event time."""
    return table(spark, sf_dir, "events").select("event_id", iso_time(F.col("ts")).alias("at"))


@query("vector_arith_join", sql="""
WITH m AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
                  count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS total
           FROM events GROUP BY ALL)
SELECT user_id, day, round((1 - (total - errors) / total) * 100, 6) AS value FROM m""")
def q_vector_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(1 - ok / total) * 100 from two metrics matched on all labels."""
    ev = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    g = ev.groupBy("user_id", "day").agg(F.count_if(F.col("event_type") == "error").alias("errors"),
                                         F.count(F.lit(1)).alias("total"))
    # two metrics of one grouped pass; matching them needs no further exchange
    long = g.select("user_id", "day", F.explode(F.create_map(
        F.lit("errors"), "errors", F.lit("total"), "total")).alias("metric", "value"))
    v = vector_arith(long, ["user_id", "day"], "metric", "value", "errors", "total",
                     lambda a, b: (F.lit(1.0) - (b - a) / b) * 100)
    return v.withColumn("value", F.round("value", 6))


@query("stream_notify", sql=f"""WITH {_alerts_sql('HighErrorRate', '_h')},
{_alerts_sql('SlowInference', '_w')},
al AS (SELECT x.*, r.severity FROM (SELECT * FROM a_h UNION ALL SELECT * FROM a_w) x
       JOIN {_RULES_SQL} USING (alertname)),
o AS (SELECT alertname, severity, epoch_us(firing_at) AS s, epoch_us(resolved_at) AS e,
             max(epoch_us(resolved_at)) OVER (PARTITION BY alertname, severity
                 ORDER BY epoch_us(firing_at), epoch_us(resolved_at), user_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end,
             user_id FROM al),
p AS (SELECT *, CAST(sum(CASE WHEN prev_end IS NULL OR s > prev_end THEN 1 ELSE 0 END)
                  OVER (PARTITION BY alertname, severity ORDER BY s, e, user_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS episode FROM o),
ep AS (SELECT alertname, severity, episode, min(s) AS f, max(e) AS t,
              min(s) + CASE WHEN severity = 'critical' THEN 10 ELSE 30 END * 1000000 AS first
       FROM p GROUP BY alertname, severity, episode)
SELECT alertname, severity, episode, 'firing' AS status, make_timestamp(first + k * 3600000000) AS at
FROM (SELECT *, unnest(generate_series(0, CAST(greatest(0, ceil((t - first) / 3600000000.0) - 1) AS BIGINT))) AS k
      FROM ep WHERE first < t)
UNION ALL
SELECT alertname, severity, episode, 'resolved', make_timestamp(t) FROM ep""")
def q_stream_notify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 (batch form): grouped notices per (alertname, severity): first
    after group_wait, hourly repeats while the episode lasts, resolved."""
    rules = spark.createDataFrame(ALERT_RULES, "alertname string, severity string, summary string, "
                                               "description string").select("alertname", "severity")
    alerts = (share_alerts(spark, sf_dir, "HighErrorRate")
              .unionByName(share_alerts(spark, sf_dir, "SlowInference"))
              .join(F.broadcast(rules), "alertname"))
    n = TS.notify_schedule(alerts, ["alertname", "severity"], key="user_id")
    return n.select("alertname", "severity", "episode", "status", "at")


# ------------------------------------------------------------------ Z4
HOUR = 3600
#: Limits and kinds of condition as in the source; ranges and times stretched
#: to the events' spacing.  An instance is a user; events of one type stand for
#: errors, idle ticks, free memory and free disk.
_RANGES = {"seen": 12, "errors": 6, "latency": 24, "active": 1, "cpu": 24, "memory": 48, "disk": 48}
_BUCKETS = [f"c{i}" for i in range(len(LATENCY_BUCKETS))]
ERROR_RATE = 0.00008


def _rule_sums() -> dict[str, RangeSum]:
    def hits(cond, metric):
        return RangeSum(F.when(cond, 1).otherwise(0).cast("long"), _RANGES[metric] * HOUR)
    any_ = F.lit(True)

    def kind(name):
        return F.col("event_type") == name
    sums = {"seen": hits(any_, "seen"), "errors": hits(kind("error"), "errors"), "active": hits(any_, "active"),
            "idle": hits(kind("click"), "cpu"), "ticks": hits(any_, "cpu"),
            "free": hits(kind("view"), "memory"), "memory": hits(any_, "memory"),
            "room": hits(kind("purchase"), "disk"), "cinf": hits(F.col("value").isNotNull(), "latency")}
    for c, b in zip(_BUCKETS, LATENCY_BUCKETS):
        sums[c] = hits(F.col("value") / 10 <= float(b), "latency")
    return sums


def _p(q: float):
    return TS.histogram_quantile_expr(q, LATENCY_BUCKETS, [F.col(c) for c in _BUCKETS], F.col("cinf"))


def _used(free: str, all_: str):
    return F.lit(100.0) - F.try_divide(F.col(free), F.col(all_)) * 100


def observability_rules() -> list[AlertRule]:
    return [
        AlertRule("AppDown", "critical", "no events", F.col("seen") == 0, 12 * HOUR),
        AlertRule("HighErrorRate", "critical", "many errors a second",
                  F.col("errors") / (_RANGES["errors"] * HOUR) > ERROR_RATE, HOUR),
        AlertRule("SlowInference", "warning", "high 95th percentile", _p(0.95) > 10, 2 * HOUR),
        AlertRule("TooManyActiveRequests", "warning", "many at once", F.col("active") > 1, 0),
        AlertRule("HighCPUUsage", "warning", "little idle time", _used("idle", "ticks") > 80, 2 * HOUR),
        AlertRule("HighMemoryUsage", "warning", "little free memory", _used("free", "memory") > 85, 2 * HOUR),
        AlertRule("HighDiskUsage", "warning", "little free disk", _used("room", "memory") > 85, 5 * HOUR),
    ]


def rule_frames(spark: SparkSession, sf_dir: str, sums=range_sums) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    return sums(ev, ["user_id"], "ts", STEP_S, _rule_sums())


def _rule_frames_sql() -> str:
    def hits(cond, metric, name):
        return (f"count(x.us) FILTER (WHERE {cond} AND x.us > g.t - {_RANGES[metric] * HOUR * 1_000_000}) AS {name}")
    parts = [hits("true", "seen", "seen"), hits("event_type = 'error'", "errors", "errors"),
             hits("true", "active", "active"), hits("event_type = 'click'", "cpu", "idle"),
             hits("true", "cpu", "ticks"), hits("event_type = 'view'", "memory", "free"),
             hits("true", "memory", "memory"), hits("event_type = 'purchase'", "disk", "room"),
             hits("value IS NOT NULL", "latency", "cinf"),
             *(hits(f"value / 10 <= {float(b)}", "latency", c) for c, b in zip(_BUCKETS, LATENCY_BUCKETS))]
    longest = max(_RANGES.values()) * HOUR * 1_000_000
    return f"""
x AS (SELECT user_id, epoch_us(ts) AS us, event_type, value FROM events),
g AS (SELECT user_id, unnest(generate_series(CAST(ceil(lo / {S_US}) AS BIGINT),
             CAST(floor((hi + {longest} - 1) / {S_US}) AS BIGINT))) * {S_US} AS t
      FROM (SELECT user_id, min(us) AS lo, max(us) AS hi FROM x GROUP BY ALL)),
f AS (SELECT g.user_id, g.t, {", ".join(parts)}
      FROM g LEFT JOIN x ON x.user_id = g.user_id AND x.us > g.t - {longest} AND x.us <= g.t GROUP BY ALL)"""


_P95, _P50 = _quantile_sql(0.95, LATENCY_BUCKETS), _quantile_sql(0.5, LATENCY_BUCKETS)
_RULE_ROWS_SQL = [
    ("AppDown", "critical", "no events", "seen = 0", 12),
    ("HighErrorRate", "critical", "many errors a second", f"errors / {6 * HOUR} > {ERROR_RATE}", 1),
    ("SlowInference", "warning", "high 95th percentile", f"({_P95}) > 10", 2),
    ("TooManyActiveRequests", "warning", "many at once", "active > 1", 0),
    ("HighCPUUsage", "warning", "little idle time", "100.0 - idle / nullif(ticks, 0) * 100 > 80", 2),
    ("HighMemoryUsage", "warning", "little free memory", "100.0 - free / nullif(memory, 0) * 100 > 85", 2),
    ("HighDiskUsage", "warning", "little free disk", "100.0 - room / nullif(memory, 0) * 100 > 85", 5),
]


@query("recorded_series", sql=f"""WITH {_rule_frames_sql()}
SELECT user_id, make_timestamp(t) AS t, round({_P95}, 6) AS p95, round({_P50}, 6) AS p50,
       round(100.0 - idle / nullif(ticks, 0) * 100, 6) AS cpu FROM f""")
def q_recorded_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorded series (95th and 50th percentile, CPU average) per
    instance on the hourly grid."""
    return rule_frames(spark, sf_dir).select(
        "user_id", "t", F.round(_p(0.95), 6).alias("p95"), F.round(_p(0.5), 6).alias("p50"),
        F.round(_used("idle", "ticks"), 6).alias("cpu"))


@query("observability", sql=f"""WITH {_rule_frames_sql()},
c AS ({" UNION ALL ".join(
    f"SELECT user_id, t, '{n}' AS alertname, '{s}' AS severity, '{m}' AS summary, "
    f"{h * HOUR * 1_000_000} AS hold FROM f WHERE {w}" for n, s, m, w, h in _RULE_ROWS_SQL)}),
i AS (SELECT *, t // {S_US} - row_number() OVER (PARTITION BY user_id, alertname ORDER BY t) AS run FROM c),
r AS (SELECT user_id, alertname, severity, summary, min(t) AS s, min(t) + hold AS f, max(t) + {S_US} AS e
      FROM i GROUP BY user_id, alertname, severity, summary, hold, run HAVING max(t) - min(t) >= hold),
k AS (SELECT * FROM r a WHERE severity = 'critical' OR NOT EXISTS (
        SELECT 1 FROM r b WHERE b.severity = 'critical' AND b.user_id = a.user_id AND a.f < b.e AND a.e > b.f))
SELECT '[' || upper(severity) || '] ' || alertname AS subject, user_id, summary,
       make_timestamp(s) AS pending_at, make_timestamp(f) AS firing_at, make_timestamp(e) AS resolved_at
FROM k""")
def q_observability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven conditions (absence, rate, quantile, gauge, three shares) per
    instance from one scan, their intervals, warnings inhibited while a
    critical alert fires on the same instance."""
    from tablekit.functions.text import status_subject
    rules = observability_rules()
    frames = rule_frames(spark, sf_dir, range_segments)
    alerts = routed_alerts(rule_intervals(frames, ["user_id"], STEP_S, rules), ["user_id"], rules)
    return alerts.select(status_subject("severity", "alertname").alias("subject"), "user_id", "summary",
                         "pending_at", "firing_at", "resolved_at")
