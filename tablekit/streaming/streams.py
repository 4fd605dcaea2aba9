"""Structured Streaming operators.

Sources are file streams (parquet / CSV folders that fill over time).  Sinks
are ``foreachBatch`` writes keyed by the batch id (``_batch=<id>`` folders,
overwritten on a retry), so a batch replayed after a failure never
duplicates rows; complete-mode results overwrite the whole table.  Event time
is turned into a zoned timestamp through epoch microseconds, so windows do
not depend on the session zone.

Finite replays (tests, backfills) end with a *late sentinel*: one row far in
the future, in its own file and its own run, that moves the watermark past
every real window and timer, so append-mode windows and event-time timeouts
all fire (Spark holds back windows still open at the watermark).
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tablekit.operators.series import epoch_us, from_epoch_us
from tablekit.session import shared_dir

SENTINEL_TS = dt.datetime(2200, 1, 1)
SENTINEL_US = (SENTINEL_TS - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


# ---------------------------------------------------------------- plumbing
def event_time(ts: Column | str) -> Column:
    """Zone-free event time to a zoned timestamp with the same wall clock in
    UTC (what ``withWatermark`` needs), independent of the session zone."""
    return F.timestamp_micros(epoch_us(ts))


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                max_files: int | None = None, **opts) -> DataFrame:
    """A folder of files read as they arrive."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


def stream_dirs(spark: SparkSession, name: str) -> dict:
    """Source, sink and checkpoint folders for one streaming job, under the
    cluster's shared checkpoint folder."""
    import uuid
    base = shared_dir(spark, "tablekit-streams", f"{name}-{uuid.uuid4().hex[:10]}")
    return {"source": f"{base}/source", "sink": f"{base}/sink", "checkpoint": f"{base}/checkpoint"}


def batch_writer(path: str, mode: str):
    """foreachBatch function: append and update mode write each batch to its
    own ``_batch=<id>`` folder (idempotent on replay); complete mode, for
    results of a few rows, overwrites."""
    def write(df: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            df.write.mode("overwrite").parquet(path)
        else:
            df.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")
    return write


def run_available_now(sdf: DataFrame, checkpoint: str, mode: str, sink=None,
                      path: str | None = None, name: str | None = None, store: str | None = None) -> None:
    """Process everything available now, in as many micro-batches as the
    source options allow, then stop.  ``store``: state store of this query."""
    w = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.foreachBatch(sink if sink is not None else batch_writer(path, mode))
    conf, name = sdf.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    try:
        if store:
            conf.set(name, store)
        q = w.trigger(availableNow=True).start()
    finally:
        conf.set(name, before)
    q.awaitTermination()


def read_sink(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.drop("_batch") if "_batch" in df.columns else df


def stage_files(df: DataFrame, path: str, parts: int, order: str | None = None) -> None:
    """Write a table as ``parts`` files (range-split on ``order``), the
    arrivals of a replayed stream."""
    d = df.repartitionByRange(parts, order) if order else df.repartition(parts)
    d.write.mode("append").parquet(path)


def add_sentinel(spark: SparkSession, path: str, schema: T.StructType, ts: str,
                 key: str, key_value=-1) -> None:
    """Append one late sentinel row (key ``key_value``, time far ahead)."""
    vals = {f.name: None for f in schema.fields}
    vals[ts] = SENTINEL_TS
    vals[key] = key_value
    row = spark.createDataFrame([tuple(vals[f.name] for f in schema.fields)], schema)
    row.coalesce(1).write.mode("append").parquet(path)


def replay(spark: SparkSession, build, dirs: dict, schema: T.StructType, mode: str,
           ts: str, key: str, sink=None, store: str | None = None) -> None:
    """Run the stream over the staged files, then twice more, each time after
    one late sentinel file: the first sentinel batch moves the watermark past
    every real window and timer, the second is a real batch that runs under
    that watermark (an ``availableNow`` run without new files does not run a
    no-data batch), so every window closes and every timer fires.  Each
    restart resumes from the checkpoint: no row is read twice."""
    def run():
        run_available_now(build(file_stream(spark, dirs["source"], schema)), dirs["checkpoint"],
                          mode, sink=sink, path=dirs["sink"], store=store)
    run()
    for _ in range(2):
        add_sentinel(spark, dirs["source"], schema, ts, key)
        run()


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last written row of each key of an update-mode sink.  A batch adds
    a folder with the keys it changed, so a write costs what the batch touched
    and a failed one leaves the rest as it was."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*keys, "_batch")]
    last = df.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in rest])
    return last.select(*keys, *rest)


# ---------------------------------------------------------------- R1
def stream_counters(events: DataFrame, labels: list[str]) -> DataFrame:
    """Running totals per label set (update mode: the changed sets of each
    batch; read them with ``read_latest``)."""
    return events.groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


# ---------------------------------------------------------------- R2 / R3 / R4
def stream_windows(events: DataFrame, ts: str, keys: list[str], size: str, slide: str | None,
                   watermark: str, aggs: list[Column]) -> DataFrame:
    """Tumbling (slide None) or sliding event-time windows with a watermark;
    output window start / end as zone-free timestamps."""
    e = events.withColumn("_et", event_time(ts)).withWatermark("_et", watermark)
    w = F.window("_et", size, slide) if slide else F.window("_et", size)
    g = e.groupBy(w.alias("w"), *keys).agg(*aggs)
    return g.select(*keys, from_epoch_us(F.unix_micros(F.col("w.start"))).alias("window_start"),
                    from_epoch_us(F.unix_micros(F.col("w.end"))).alias("window_end"),
                    *[c for c in g.columns if c not in ("w", *keys)])


# ---------------------------------------------------------------- R6 / R10
#: Rows of state by key, with timers: kept on the executors' disks, not in the
#: JVM's heap; a batch touches the rows it has input or a due timer for.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def closed_cells(events: DataFrame, key: str, ts: str, cell_us: int, watermark: str) -> DataFrame:
    """(key, lo_us, hi_us, w): first and last event of each key in each time
    cell, once the watermark has closed the cell.  The key travels as text, as
    pandas would make floats of whole numbers beside a null.

    This is the level that sees events: partial sums in every task and a state
    row per (key, cell), so a key with a third of the events is many rows in
    many tasks.  Cells close in order of time, so what comes later never lies
    before what came, and the next level needs no waiting lists."""
    e = events.withColumn("_et", event_time(ts)).withWatermark("_et", watermark)
    return (e.groupBy(F.col(key).cast("string").alias("key"), F.window("_et", f"{cell_us} microseconds").alias("w"))
             .agg(F.min(epoch_us(ts)).alias("lo_us"), F.max(epoch_us(ts)).alias("hi_us")))


class _CellProcessor(StatefulProcessor):
    """One small state row per key and at most one timer, set to the end of
    the cell by which a run must have gone on (``reach_us`` after its last
    event).  Subclasses define ``take`` and ``expire``."""

    schema, columns = "", ()

    def __init__(self, reach_us: int, cell_us: int):
        self.reach, self.cell = reach_us, cell_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", self.schema + ", timer long")

    def _due(self, last: int) -> int:
        """Watermark (ms) from which no event up to last + reach can come."""
        return -(-((last + self.reach) // self.cell + 1) * self.cell // 1000)

    def _run(self, key, cells, watermark_ms: int, expired: bool):
        k = None if pd.isna(key[0]) else int(key[0])
        *run, timer = self.state.get() if self.state.exists() else [None] * len(self.schema.split(",")) + [None]
        out: list[tuple] = []
        for lo, hi in cells:
            run = self.take(k, run, lo, hi, out)
        if timer is not None and not expired:
            self.handle.deleteTimer(timer)
        timer, last = None, self.last(run)
        if last is not None:
            if self._due(last) <= watermark_ms:
                run = self.expire(k, run, out)
            else:
                timer = self._due(last)
                self.handle.registerTimer(timer)
        if run[0] is None:
            self.state.clear()
        else:
            self.state.update((*run, timer))
        yield pd.DataFrame(out, columns=list(self.columns)).astype("Int64")

    def handleInputRows(self, key, rows, timerValues):
        cells = sorted((int(a), int(b)) for p in rows for a, b in zip(p["lo_us"], p["hi_us"]))
        yield from self._run(key, cells, timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._run(key, [], timerValues.getCurrentWatermarkInMs(), True)

    def close(self) -> None:
        pass


class AlertRuns(_CellProcessor):
    """(since, last) of the current run of true condition samples.  A gap of
    over ``reach`` (the grid step) closes the run; one of at least ``for``
    fired: (pending, firing, resolved)."""

    schema = "since long, last long"
    columns = ("instance", "pending_us", "firing_us", "resolved_us")

    def __init__(self, step_us: int, for_us: int):
        super().__init__(step_us, step_us)
        self.hold = for_us

    def last(self, run):
        return run[1]

    def take(self, key, run, lo, hi, out):
        since, last = run
        if last is not None and lo > last + self.reach:
            since, last = self.expire(key, run, out)
        return [lo if since is None else since, hi]

    def expire(self, key, run, out):
        since, last = run
        if last - since >= self.hold:
            out.append((key, since, since + self.hold, last + self.reach))
        return [None, None]


class Silences(_CellProcessor):
    """(last, noticed): the last event of a source and whether its open
    silence was reported.  The row stays for good, so a silence of any length
    is closed by the event that ends it."""

    schema = "last long, noticed boolean"
    columns = ("user_id", "from_us", "to_us")

    def last(self, run):
        return None if run[0] is None or run[1] else run[0]

    def take(self, key, run, lo, hi, out):
        if run[0] is not None and lo - run[0] > self.reach:
            out.append((key, run[0], lo))
        return [hi, False]

    def expire(self, key, run, out):
        out.append((key, run[0], None))
        return [run[0], True]


ALERT_OUT = "instance long, pending_us long, firing_us long, resolved_us long"
GAP_OUT = "user_id long, from_us long, to_us long"


def stream_alert_state(cond: DataFrame, instance: str, t: str, step_s: int, for_s: int,
                       watermark: str = "1 day") -> DataFrame:
    """Alert intervals from a stream of true-condition grid samples, in
    any order within ``watermark``: cells of a step first, then runs of cells
    with event-time timers.  Run it with ``STATE_STORE``."""
    cells = closed_cells(cond, instance, t, step_s * 1_000_000, watermark)
    return cells.groupBy("key").transformWithStateInPandas(
        AlertRuns(step_s * 1_000_000, for_s * 1_000_000), ALERT_OUT, "Append", "EventTime")


def stream_no_data(events: DataFrame, key: str, ts: str, limit_s: int, watermark: str = "1 day",
                   cells: int = 4) -> DataFrame:
    """Silent intervals per source, carried across micro-batches; events
    may come in any order within ``watermark``.

    Events are summed up by cells of a ``cells``-th of the limit (a silence
    never fits in one), then cells by source.  A timer reports a source that
    stays silent past the limit, at most a cell later, as an open interval
    (``to_us`` NULL).  When it speaks again the closed interval with the same
    start follows.  Run it with ``STATE_STORE``."""
    cell_us = max(1, limit_s * 1_000_000 // cells)
    return closed_cells(events, key, ts, cell_us, watermark).groupBy("key").transformWithStateInPandas(
        Silences(limit_s * 1_000_000, cell_us), GAP_OUT, "Append", "EventTime")


# ---------------------------------------------------------------- R9 / R12 / R13
def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_wins_sink(table_path: str, key: str, order: list[str], writer: str):
    """foreachBatch insert-or-ignore into a table with a unique key
    (unbounded horizon).  A batch reads only the key buckets that it may hit;
    ``writer`` and the batch's number make a retried batch insert once, and
    other writers may insert meanwhile."""
    from tablekit.sources.keyed import UniqueTable

    def write(df: DataFrame, batch_id: int) -> None:
        UniqueTable(df.sparkSession, table_path, key, order).insert(df, writer, batch_id)
    return write


def validate_sink(valid_path: str, bad_path: str, col: str, strict: bool = True):
    """foreachBatch with two writes, valid rows and quarantine."""
    from tablekit.operators.shape import validate_nonempty

    def write(df: DataFrame, batch_id: int) -> None:
        ok, bad = validate_nonempty(df, col, strict)
        ok.write.mode("overwrite").parquet(f"{valid_path}/_batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{bad_path}/_batch={batch_id}")
    return write


def threshold_notify_sink(notice_path: str, limit: int, once: bool = True):
    """The running success count is a one-row complete-mode aggregate;
    a notice row is appended when it reaches ``limit`` (only the first time
    with ``once``, the source's behaviour of firing every run otherwise)."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        reached = df.filter(F.col("count") >= limit)
        if once and path_exists(spark, notice_path):  # at most one row per batch
            if spark.read.parquet(notice_path).filter(F.col("_batch") != batch_id).count():
                reached = reached.limit(0)
        reached.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{notice_path}/_batch={batch_id}")
    return write


# ---------------------------------------------------------------- R8
INHIBIT_OUT = ALERT_OUT


class Inhibitor(StatefulProcessor):
    """Targets that no source overlaps (s.start < t.end and s.end > t.start),
    per instance.

    Sources wait in the time bucket of their start and targets in that of
    their end, in one state row a bucket and batch, so that adding rows reads
    none.  Once the watermark has passed a bucket all sources that start in it
    or before it are known; its rows are sorted once and merged with the latest
    end of all earlier sources, which is all that is kept of them.  An instance
    has one timer, at the end of its earliest bucket, and a call settles every
    bucket that is due: a watermark that leaps over a thousand buckets is one
    call, not a thousand that each list what waits."""

    columns = ("instance", "pending_us", "firing_us", "resolved_us")

    def __init__(self, bucket_ms: int):
        self.bucket = bucket_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "e long, batches long, timer long")
        self.rows = handle.getMapState("rows", "b long, batch long", "sources array<struct<s:long,e:long>>, "
                                                                     "targets array<struct<s:long,e:long,p:long>>")

    def _kept(self):
        return self.latest.get() if self.latest.exists() else (-(1 << 62), 0, None)

    def handleInputRows(self, key, rows, timerValues):
        new: dict[int, tuple[list, list]] = {}
        for p in rows:
            for kind, s, e, pending in zip(p["kind"], p["s_us"].tolist(), p["e_us"].tolist(), p["p_us"].tolist()):
                at = (s if kind == "source" else e) // (self.bucket * 1000)
                sources, targets = new.setdefault(at, ([], []))
                sources.append((s, e)) if kind == "source" else targets.append((s, e, pending))
        if new:
            latest, batch, timer = self._kept()
            for at, row in new.items():
                self.rows.updateValue((at, batch), row)
            due = (min(new) + 1) * self.bucket
            if timer is None or due < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
                timer = due
            self.latest.update((latest, batch + 1, timer))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        done = timerValues.getCurrentWatermarkInMs() // self.bucket
        latest, batches, _ = self._kept()
        waiting = [tuple(k) for k in self.rows.keys()]
        due = [k for k in waiting if k[0] < done]
        if len(due) == len(waiting):  # read and dropped as a whole
            found = list(zip(waiting, map(tuple, self.rows.values())))
            self.rows.clear()
        else:
            found = [(k, tuple(self.rows.getValue(k))) for k in due]
            for k in due:
                self.rows.removeKey(k)
        buckets: dict[int, tuple[list, list]] = {}
        for (at, _), row in found:
            for kept, more in zip(buckets.setdefault(at, ([], [])), row):
                kept.extend(map(tuple, more))
        out = []
        for at in sorted(buckets):
            sources, targets = map(sorted, buckets[at])
            i = 0
            for s, e, pending in sorted(targets, key=lambda t: t[1]):
                while i < len(sources) and sources[i][0] < e:
                    latest = max(latest, sources[i][1])
                    i += 1
                if latest <= s:
                    out.append((None if pd.isna(key[0]) else int(key[0]), pending, s, e))
            latest = max([latest, *(e for _, e in sources[i:])])
        timer = min(((at + 1) * self.bucket for at, _ in waiting if at >= done), default=None)
        if timer is not None:
            self.handle.registerTimer(timer)
        self.latest.update((latest, batches, timer))
        if out:
            yield pd.DataFrame(out, columns=list(self.columns)).astype("Int64")

    def close(self) -> None:
        pass


def stream_inhibit(alerts: DataFrame, instance: str, watermark: str = "1 day", bucket_s: int = 3600) -> DataFrame:
    """Targets suppressed while an overlapping source alert fires on the
    same instance, on a stream of (instance, kind, pending_at, firing_at,
    resolved_at) rows (kind 'source' or 'target'); event time = firing_at.  A
    target is decided at most a bucket after its end.  Run it with
    ``STATE_STORE``."""
    a = (alerts.withColumn("_et", event_time("firing_at")).withWatermark("_et", watermark)
         .select(F.col(instance).cast("string").alias("key"), "kind", epoch_us("firing_at").alias("s_us"),
                 epoch_us("resolved_at").alias("e_us"), epoch_us("pending_at").alias("p_us"), "_et"))
    return a.groupBy("key").transformWithStateInPandas(Inhibitor(bucket_s * 1000), INHIBIT_OUT, "Append", "EventTime")
