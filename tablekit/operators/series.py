"""Metric time series in batch (W4-W10, J3 via joins, G21).

Samples are rows (series labels..., ts, value).  Range functions are
evaluated on a step grid like a range query: at each grid time t over the
samples in (t - range, t].

Skew: evaluation is partitioned by (series, time bucket), never by series
alone.  Each sample lives in its bucket and, when it lies within ``range`` of
the next bucket's start, also in that bucket (a halo), so every frame
(t - range, t] of a grid time in bucket b is complete inside partition b.  A
series holding a third of all samples is spread over all its buckets.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.operators.splits import group_rank, group_running_sum

EPOCH_NTZ = dt.datetime(1970, 1, 1)


def ntz_literal(t: dt.datetime) -> Column:
    """A zone-free timestamp literal built from text, so neither the Python
    process's zone nor the session zone moves it."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
DAY_US = 86_400 * 1_000_000


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a zone-free or zoned timestamp, with
    no round trip through the session zone."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", ntz_literal(EPOCH_NTZ),
                            t.cast("timestamp_ntz"))


def from_epoch_us(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, ntz_literal(EPOCH_NTZ))


# ---------------------------------------------------------------- sliding core
def sliding_eval(samples: DataFrame, series: list[str], ts: str, step_s: int, range_s: int,
                 aggs: dict, prep=None, bucket_s: int | None = None) -> DataFrame:
    """Evaluate aggregates over (t - range, t] at every grid time t (multiples
    of ``step``) that has at least one sample in its frame.

    ``aggs``: name -> fn(frame WindowSpec) -> Column, evaluated on grid rows;
    sample rows have ``_kind`` = 0, grid rows 1 and NULL sample columns.
    ``prep(df, part)``: optional per-partition step before the union (e.g. a
    ``lag`` delta), with ``part`` the ordered WindowSpec of a partition.
    Output: series..., t (timestamp), _t_us, aggregates.
    """
    W = range_s * 1_000_000
    S = step_s * 1_000_000
    B = max(bucket_s * 1_000_000 if bucket_s else DAY_US, W)
    s = samples.withColumn("_us", epoch_us(ts))
    b = F.floor(F.col("_us") / B).cast("long")
    halo = F.col("_us") >= (b + 1) * B - W
    s = s.withColumn("_b", F.explode(F.when(halo, F.array(b, b + 1)).otherwise(F.array(b))))
    part_keys = [*series, "_b"]
    ordered = Window.partitionBy(*part_keys).orderBy("_us")
    if prep is not None:
        s = prep(s, ordered)
    s = s.withColumn("_kind", F.lit(0))
    # grid: step multiples inside the bucket that can see a sample
    rng = s.groupBy(*part_keys).agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
    lo_k = F.ceil(F.greatest(F.col("_lo"), F.col("_b") * B) / S)
    hi_k = F.floor(F.least(F.col("_hi") + W - 1, (F.col("_b") + 1) * B - 1) / S)
    grid = (rng.filter(lo_k <= hi_k)
               .select(*part_keys, F.explode(F.sequence(lo_k.cast("long"), hi_k.cast("long")))
                       .alias("_k"))
               .select(*part_keys, (F.col("_k") * S).alias("_us"), F.lit(1).alias("_kind")))
    both = s.unionByName(grid, allowMissingColumns=True)
    frame = Window.partitionBy(*part_keys).orderBy("_us").rangeBetween(-W + 1, 0)
    cols = [fn(frame).alias(name) for name, fn in aggs.items()]
    # samples in the frame; a grid time whose frame is empty has no value
    cols.append(F.count_if(F.col("_kind") == 0).over(frame).alias("_ns"))
    out = (both.select(*series, "_us", "_kind", *cols)
               .filter((F.col("_kind") == 1) & (F.col("_ns") > 0)))
    return out.select(*series, from_epoch_us(F.col("_us")).alias("t"), F.col("_us").alias("_t_us"),
                      *aggs.keys())


def sliding_totals(samples: DataFrame, series: list[str], ts: str, step_s: int, range_s: int,
                   sums: dict, max_fanout: int = 64) -> DataFrame:
    """Sums over (t - range, t] on the step grid, for additive measures only
    (counts, sums, conditional counts).

    ``sums``: name -> Column over the sample columns, summed per frame.
    When the range is a whole number of steps, the frame of grid time kS is
    exactly the step cells k - n + 1 .. k (cell c holds (c - 1)S < us <= cS).
    So each sample goes to the n grid times that see it and one grouped sum
    finishes the job: no window and no sort, a map-side partial sum per task,
    and a hot series spreads over all its grid keys.  Otherwise it falls back
    to ``sliding_eval``, as it does when a sample would reach more than
    ``max_fanout`` grid times (a long range on a short step), where copying
    every sample that often costs more than one windowed sort.  Output as
    ``sliding_eval``: series..., t, _t_us, sums (only grid times whose frame
    holds a sample).
    """
    if range_s % step_s or range_s // step_s > max_fanout:
        vals = samples.withColumns({f"_v_{n}": c for n, c in sums.items()})
        aggs = {n: (lambda col: lambda w: F.sum(col).over(w))(f"_v_{n}") for n in sums}
        return sliding_eval(vals, series, ts, step_s, range_s, aggs)
    S = step_s * 1_000_000
    n = range_s // step_s
    us = epoch_us(ts)
    rem = F.pmod(us, F.lit(S))
    cell = (us - rem) / F.lit(S) + F.when(rem != 0, 1).otherwise(0)
    s = samples.select(*series, cell.cast("long").alias("_c"),
                       *[c.alias(name) for name, c in sums.items()])
    grid = s.select(*series, F.explode(F.sequence(F.col("_c"), F.col("_c") + (n - 1))).alias("_k"),
                    *sums.keys())
    out = grid.groupBy(*series, "_k").agg(*[F.sum(name).alias(name) for name in sums])
    t_us = F.col("_k") * F.lit(S)
    return out.select(*series, from_epoch_us(t_us).alias("t"), t_us.alias("_t_us"), *sums.keys())


# ---------------------------------------------------------------- W6
def counter_cells(samples: DataFrame, series: list[str], ts: str, value: str, cell_s: int) -> DataFrame:
    """Mergeable summaries of a counter's samples: (series..., _c, _n, _first,
    _last, _inc, _t0, _t1) per cell c, which holds ((c - 1) cell, c cell].

    ``_inc`` adds the deltas between consecutive samples of the cell; a drop is
    a reset and counts the new value.  Samples of one time are read in
    ascending value; null times and values are no samples.  Only this step
    sorts samples, one (series, cell) at a time.
    """
    size = cell_s * 1_000_000
    us = epoch_us(ts)
    rem = F.pmod(us, F.lit(size))
    s = (samples.filter(F.col(ts).isNotNull() & F.col(value).isNotNull())
         .select(*series, us.alias("_us"), F.col(value).cast("double").alias("_v"),
                 ((us - rem) / F.lit(size) + F.when(rem != 0, 1).otherwise(0)).cast("long").alias("_c")))
    w = Window.partitionBy(*series, "_c").orderBy("_us", "_v")
    before, after = F.lag("_v").over(w), F.lead("_v").over(w)
    s = s.select(*series, "_c", "_us", "_v", before.alias("_p"), after.isNull().alias("_end"))
    return s.groupBy(*series, "_c").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col("_p").isNull(), F.col("_v"))).alias("_first"),
        F.sum(F.when(F.col("_end"), F.col("_v"))).alias("_last"),
        F.sum(_step("_p", "_v")).alias("_inc"), F.min("_us").alias("_t0"), F.max("_us").alias("_t1"))


def _step(before: str, value: str) -> Column:
    """Increase from one reading to the next; 0 without an earlier one."""
    return (F.when(F.col(before).isNull(), F.lit(0.0)).when(F.col(value) < F.col(before), F.col(value))
            .otherwise(F.col(value) - F.col(before)))


def _merged_cells(cells: DataFrame, series: list[str], cell_s: int, n: int, m: int) -> DataFrame:
    """Frames of n cells ending at every m-th cell: each cell goes to the grid
    times that see it, with the step from the last cell before it if that lies
    in the frame too."""
    size = max(4096, n)  # a series with very many cells is many partitions
    b = F.floor(F.col("_c") / size).cast("long")
    halo = F.col("_c") >= (b + 1) * size - n
    c = cells.withColumn("_b", F.explode(F.when(halo, F.array(b, b + 1)).otherwise(F.array(b))))
    w = Window.partitionBy(*series, "_b").orderBy("_c")
    c = (c.withColumn("_pc", F.lag("_c").over(w)).withColumn("_p", F.lag("_last").over(w))
         .filter(F.floor(F.col("_c") / size) == F.col("_b")))
    lo, hi = F.ceil(F.col("_c") / m), F.floor((F.col("_c") + (n - 1)) / m)
    c = (c.filter(lo <= hi).select("*", _step("_p", "_first").alias("_gap"),
                                   F.explode(F.sequence(lo.cast("long"), hi.cast("long"))).alias("_k")))
    seen = F.col("_pc") > F.col("_k") * m - n
    return c.groupBy(*series, "_k").agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_inc") + F.when(seen, F.col("_gap")).otherwise(0.0)).alias("_inc"),
        F.min("_t0").alias("_t0"), F.max("_t1").alias("_t1"), F.min_by("_first", "_c").alias("_v0")
    ).withColumn("_t_us", F.col("_k") * (m * cell_s * 1_000_000))


def _framed_cells(cells: DataFrame, series: list[str], cell_s: int, range_s: int, step_s: int) -> DataFrame:
    """The same by one sliding window over the cells, for ranges of very many
    steps: the step into the frame's first cell is taken off again."""
    def prep(df, part):
        return df.withColumn("_p", F.lag("_last").over(part)).withColumn("_gap", _step("_p", "_first"))
    r = sliding_eval(cells.withColumn("_at", from_epoch_us(F.col("_c") * (cell_s * 1_000_000))), series, "_at",
                     step_s, range_s, {
        "_n": lambda w: F.sum("_n").over(w),
        "_sum": lambda w: F.sum(F.col("_inc") + F.col("_gap")).over(w),
        "_skip": lambda w: F.first("_gap", ignorenulls=True).over(w),
        "_t0": lambda w: F.min("_t0").over(w), "_t1": lambda w: F.max("_t1").over(w),
        "_v0": lambda w: F.first("_first", ignorenulls=True).over(w)}, prep=prep)
    return r.withColumn("_inc", F.col("_sum") - F.col("_skip"))


def counter_rate(samples: DataFrame, series: list[str], ts: str = "ts", value: str = "value",
                 range_s: int = 300, step_s: int = 15, extrapolate: bool = False,
                 max_fanout: int = 64) -> DataFrame:
    """Per-second increase of a counter over (t - range, t] on the step grid.

    Increase = sum of the deltas between consecutive samples inside the
    frame; a drop is a counter reset and counts the new value; at least two
    samples are needed.  Samples are summed up by cells of the largest time
    that divides range and step, and cells are merged over the range, so a hot
    series is as many groups as it has cells.  Ties: see ``counter_cells``.
    ``extrapolate`` stretches the increase to the edges of the range like the
    usual monitoring rule: a gap to an edge counts in full when shorter than
    1.1 average sample intervals, else as half an interval, and the start
    never reaches below the counter's zero.
    """
    cell_s = math.gcd(range_s, step_s)
    cells = counter_cells(samples, series, ts, value, cell_s)
    if range_s <= max_fanout * step_s:
        r = _merged_cells(cells, series, cell_s, range_s // cell_s, step_s // cell_s)
    else:
        r = _framed_cells(cells, series, cell_s, range_s, step_s)
    r = r.filter(F.col("_n") >= 2).withColumn("t", from_epoch_us(F.col("_t_us")))
    if not extrapolate:
        return r.select(*series, "t", (F.col("_inc") / range_s).alias("rate"))
    sampled = (F.col("_t1") - F.col("_t0")) / 1e6
    avg = sampled / (F.col("_n") - 1)
    to_start = (F.col("_t0") - (F.col("_t_us") - range_s * 1_000_000)) / 1e6
    to_end = (F.col("_t_us") - F.col("_t1")) / 1e6
    to_start = F.when(to_start >= avg * 1.1, avg / 2).otherwise(to_start)
    to_zero = sampled * (F.col("_v0") / F.col("_inc"))
    to_start = F.when((F.col("_inc") > 0) & (F.col("_v0") >= 0) & (to_zero < to_start), to_zero) \
                .otherwise(to_start)
    to_end = F.when(to_end >= avg * 1.1, avg / 2).otherwise(to_end)
    factor = F.try_divide(sampled + to_start + to_end, sampled)
    return r.select(*series, "t", (F.col("_inc") * factor / range_s).alias("rate"))


# ---------------------------------------------------------------- W7
def histogram_quantile_expr(q: float, bounds: list[float], cum: list[Column],
                            total: Column) -> Column:
    """q-quantile from cumulative bucket counts (or rates) ``cum`` for the
    finite ``bounds`` and ``total`` for +Inf: linear interpolation inside the
    crossing bucket, lower edge 0 for the first bucket, the largest finite
    bound when the crossing bucket is +Inf, NULL when the total is 0."""
    rank = F.lit(q) * total
    out = None
    for i, (ub, c) in enumerate(zip(bounds, cum)):
        lb = F.lit(0.0) if i == 0 else F.lit(float(bounds[i - 1]))
        prev = F.lit(0.0) if i == 0 else cum[i - 1].cast("double")
        val = lb + (F.lit(float(ub)) - lb) * F.coalesce(
            F.try_divide(rank - prev, c.cast("double") - prev), F.lit(0.0))
        cond = c >= rank
        out = F.when(cond, val) if out is None else out.when(cond, val)
    out = out.otherwise(F.lit(float(bounds[-1])))
    return F.when(total > 0, out)


def sliding_histogram_quantile(samples: DataFrame, series: list[str], ts: str, value: str,
                               bounds: list[float], qs: list[float], range_s: int,
                               step_s: int) -> DataFrame:
    """Quantiles of ``value`` over (t - range, t] from bucket counts: each
    sample increments the cumulative buckets value <= le; the rates share the
    same 1/range factor, so quantiles come from the counts directly."""
    sums = {f"_c{i}": F.when(F.col(value) <= F.lit(float(b)), 1).otherwise(0).cast("long")
            for i, b in enumerate(bounds)}
    sums["_cinf"] = F.when(F.col(value).isNotNull(), 1).otherwise(0).cast("long")
    r = sliding_totals(samples, series, ts, step_s, range_s, sums)
    cum = [F.col(f"_c{i}") for i in range(len(bounds))]
    qcols = [histogram_quantile_expr(q, bounds, cum, F.col("_cinf")).alias(f"q{int(q * 100):02d}")
             for q in qs]
    return r.select(*series, "t", (F.col("_cinf") / range_s).alias("count_rate"), *qcols)


# ---------------------------------------------------------------- W9 / W10
def islands(df: DataFrame, series: list[str], t_us: str, step_s: int) -> DataFrame:
    """Runs of consecutive grid times (gap = one step) per series:
    (series..., start_us, end_us, points).  Island id = grid index - rank,
    with the rank computed range-partitioned (no per-series single task)."""
    S = step_s * 1_000_000
    r = group_rank(df.select(*series, t_us), [t_us], group=series, name="_r")
    g = r.withColumn("_isl", F.floor(F.col(t_us) / S).cast("long") - F.col("_r"))
    return g.groupBy(*series, "_isl").agg(F.min(t_us).alias("start_us"),
                                          F.max(t_us).alias("end_us"),
                                          F.count(F.lit(1)).alias("points")).drop("_isl")


def alert_intervals(cond_rows: DataFrame, series: list[str], step_s: int, for_s: int,
                    alertname: str, t: str = "t") -> DataFrame:
    """Alert intervals from grid rows where the condition holds.

    An island of consecutive true grid times [s, e] is pending from s and
    fires from s + for when e - s >= for; the alert resolves one step after
    e.  Output: series..., alertname, pending_at, firing_at, resolved_at.
    """
    rows = cond_rows.withColumn("_t_us", epoch_us(t))
    isl = islands(rows, series, "_t_us", step_s)
    F_ = for_s * 1_000_000
    fired = isl.filter(F.col("end_us") - F.col("start_us") >= F_)
    return fired.select(*series, F.lit(alertname).alias("alertname"),
                        from_epoch_us(F.col("start_us")).alias("pending_at"),
                        from_epoch_us(F.col("start_us") + F_).alias("firing_at"),
                        from_epoch_us(F.col("end_us") + step_s * 1_000_000).alias("resolved_at"))


def liveness_gaps(df: DataFrame, series: list[str], ts: str, limit_s: int, key: str) -> DataFrame:
    """Silent intervals: the next sample of a series comes more than
    ``limit_s`` after this one (``up == 0`` in between).  The next sample is
    found by rank + equi join, not a per-series window."""
    from tablekit.operators.splits import next_row
    n = next_row(df.select(*series, ts, key), [ts, key], series, [ts])
    gap = F.timestamp_diff("SECOND", F.col(ts), F.col("next_" + ts))
    return (n.filter(gap > limit_s)
             .select(*series, F.col(ts).alias("silent_from"), F.col("next_" + ts).alias("silent_to"),
                     gap.alias("gap_s")))


# ---------------------------------------------------------------- W8
def inflight_gauge(df: DataFrame, series: list[str], start: str, end: str, key: str) -> DataFrame:
    """Requests in flight after each start / end event: +1 at start, -1 at
    end (also for failed calls), running sum per series in time order; at
    equal times ends count before starts.  The running sum is range
    partitioned (a very large series spans many tasks)."""
    ev = df.select(*series, key, F.inline(F.array(
        F.struct(F.col(start).alias("at_time"), F.lit(1).alias("delta"), F.lit(1).alias("_o")),
        F.struct(F.col(end).alias("at_time"), F.lit(-1).alias("delta"), F.lit(0).alias("_o")))))
    r = group_running_sum(ev, ["at_time", "_o", key], "delta", series, name="in_flight")
    return r.drop("_o")


# ---------------------------------------------------------------- W4
def early_stop(history: DataFrame, run: str, epoch: str, metric: str, patience: int,
               mode: str = "min") -> DataFrame:
    """Per run: best epoch, best value and stop epoch of patience-based early
    stopping (strict improvement: < for a loss, > for a score).

    A history is one row per epoch of a run (small by nature), so plain
    windows per run are used.  An epoch improves when it beats every earlier
    epoch; training stops at the first epoch that is ``patience`` epochs after
    the last improvement (or runs to the end).
    """
    w_prev = Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    w_run = Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)
    best_prev = (F.min if mode == "min" else F.max)(metric).over(w_prev)
    better = (F.col(metric) < best_prev) if mode == "min" else (F.col(metric) > best_prev)
    h = history.withColumn("improved", best_prev.isNull() | better)
    h = h.withColumn("last_improved", F.max(F.when(F.col("improved"), F.col(epoch))).over(w_run))
    h = h.withColumn("stale", F.col(epoch) - F.col("last_improved"))
    stops = h.filter(F.col("stale") >= patience).groupBy(run).agg(F.min(epoch).alias("stop_epoch"))
    # best epoch among epochs up to the stop (or all)
    j = h.join(stops, run, "left")
    seen = j.filter(F.col("stop_epoch").isNull() | (F.col(epoch) <= F.col("stop_epoch")))
    order = F.struct((F.col(metric) if mode == "min" else -F.col(metric)), F.col(epoch))
    best = seen.groupBy(run).agg(
        F.min_by(F.col(epoch), order).alias("best_epoch"),
        (F.min if mode == "min" else F.max)(metric).alias("best_value"),
        F.max(epoch).alias("last_epoch"), F.first("stop_epoch", ignorenulls=True).alias("stop_epoch"))
    return best.withColumn("stopped_early", F.col("stop_epoch").isNotNull())


# ---------------------------------------------------------------- W5
def latest_value(df: DataFrame, series: list[str], ts: str, value: str) -> DataFrame:
    """Last non-NULL value per series (an aggregate, no sort)."""
    nn = df.filter(F.col(value).isNotNull())
    return nn.groupBy(*series).agg(F.max_by(value, ts).alias(f"last_{value}"),
                                   F.max(ts).alias(f"last_{ts}"))


# ---------------------------------------------------------------- R7 (batch form)
# Routing timers (seconds).
GROUP_WAIT_S = 30
GROUP_WAIT_CRITICAL_S = 10
REPEAT_INTERVAL_S = 3600


def notify_schedule(alerts: DataFrame, group: list[str], start: str = "firing_at",
                    end: str = "resolved_at", key: str = "instance",
                    severity: str = "severity") -> DataFrame:
    """Notices of alert groups: overlapping firing intervals of a group merge
    into an episode; the first notice goes out ``group_wait`` after the
    episode starts (10 s when critical, else 30 s), repeats every hour while
    it lasts, and a resolved notice ends it.

    Episodes are gaps and islands on intervals: an interval opens a new
    episode when it starts after every earlier interval of the group has
    ended (exclusive running max of ends), and the episode number is a
    running count of openings, both range-partitioned, so a group holding
    most alerts is still spread over many tasks.
    """
    a = alerts.select(*group, key, F.col(start).alias("_s"), F.col(end).alias("_e"))
    a = a.withColumn("_s_us", epoch_us("_s")).withColumn("_e_us", epoch_us("_e"))
    order = ["_s_us", "_e_us", key]
    m = group_running_sum(a, order, "_e_us", group, name="_prev_end", agg="max", inclusive=False)
    m = m.withColumn("_open", F.when(F.col("_prev_end").isNull() | (F.col("_s_us") > F.col("_prev_end")),
                                     1).otherwise(0))
    ep = group_running_sum(m, order, "_open", group, name="_episode")
    episodes = ep.groupBy(*group, "_episode").agg(F.min("_s_us").alias("_from"),
                                                 F.max("_e_us").alias("_to"))
    wait = F.when(F.col(severity) == "critical", F.lit(GROUP_WAIT_CRITICAL_S)).otherwise(
        F.lit(GROUP_WAIT_S)) * 1_000_000
    first = F.col("_from") + wait
    n_rep = F.greatest(F.lit(0), F.ceil((F.col("_to") - first) / (REPEAT_INTERVAL_S * 1_000_000)) - 1)
    fire = (episodes.filter(first < F.col("_to"))
                    .select(*group, "_episode", F.explode(F.sequence(F.lit(0).cast("long"), n_rep.cast("long")))
                            .alias("_k"), first.alias("_first"))
                    .select(*group, "_episode", F.lit("firing").alias("status"),
                            (F.col("_first") + F.col("_k") * REPEAT_INTERVAL_S * 1_000_000).alias("_at")))
    resolved = episodes.select(*group, "_episode", F.lit("resolved").alias("status"),
                               F.col("_to").alias("_at"))
    return fire.unionByName(resolved).select(*group, F.col("_episode").alias("episode"), "status",
                                             from_epoch_us(F.col("_at")).alias("at"))
