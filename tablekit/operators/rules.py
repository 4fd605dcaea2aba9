"""A table of alert rules as one evaluation.

All rules read sums of samples over sliding ranges.  The sums of every rule,
with their different ranges, come from one scan and one running total: a cell
of samples adds itself at its own grid time and takes itself off where it
leaves each range, so it is one row a range and not one a grid time.  Between
two changes all sums stand still, and the conditions are expressions on one
row per such segment; the intervals of all rules come from one pass over the
true ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.operators.joins import inhibit
from tablekit.operators.series import epoch_us, from_epoch_us


@dataclass(frozen=True)
class RangeSum:
    """Sum of ``value`` (over the sample columns) over (t - range_s, t]."""
    value: Column
    range_s: int


@dataclass(frozen=True)
class AlertRule:
    """``condition`` over the sums must hold for ``for_s``."""
    name: str
    severity: str
    summary: str
    condition: Column
    for_s: int


def range_segments(samples: DataFrame, series: list[str], ts: str, step_s: int,
                   sums: dict[str, RangeSum]) -> DataFrame:
    """(series..., _k, _last, sums): stretches of grid times with the same
    sums, from a series' first sample until its last has left the longest
    range.  Ranges are whole numbers of steps.

    Cells are shuffled to their series once; what follows stays there.  Whole
    numbers and decimals are running totals; floating sums are added up anew in
    each frame, as taking off would leave their rounding behind."""
    if any(s.range_s % step_s for s in sums.values()):
        raise ValueError("ranges must be whole numbers of steps")
    size = step_s * 1_000_000
    us = epoch_us(ts)
    rem = F.pmod(us, F.lit(size))
    cell = ((us - rem) / F.lit(size) + F.when(rem != 0, 1).otherwise(0)).cast("long")
    # cells first: samples of one cell leave every frame together
    cells = (samples.filter(F.col(ts).isNotNull())
             .select(*series, cell.alias("_c"), *[s.value.alias(k) for k, s in sums.items()])
             .groupBy(*series, "_c").agg(*[F.sum(k).alias(k) for k in sums]))
    floating = {f.name for f in cells.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    ranges = sorted({s.range_s // step_s for s in sums.values()})
    # a fixed number of parts: merged ones would be small to send and large to sort
    parts = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    changes = (cells.repartition(parts, *series)
               .withColumn("_o", F.explode(F.array(*[F.lit(r).cast("long") for r in [0, *ranges]]))))

    def change(name):
        v = F.coalesce(F.col(name), F.lit(0))
        here = F.when(F.col("_o") == 0, v)
        return here if name in floating else here.when(F.col("_o") == sums[name].range_s // step_s, -v)
    changes = changes.select(*series, (F.col("_c") + F.col("_o")).alias("_k"),
                             *[F.coalesce(change(k), F.lit(0)).alias(k) for k in sums])
    order = Window.partitionBy(*series).orderBy("_k")

    def total(name):
        if name in floating:
            return F.sum(name).over(order.rangeBetween(1 - sums[name].range_s // step_s, 0))
        return F.sum(name).over(order.rangeBetween(Window.unboundedPreceding, 0))
    # the last change of a series only takes off: its time is past the grid
    return (changes.select(*series, "_k", (F.lead("_k").over(order) - 1).alias("_last"),
                           *[total(k).alias(k) for k in sums])
            .filter(F.col("_last") >= F.col("_k")))


def range_sums(samples: DataFrame, series: list[str], ts: str, step_s: int,
               sums: dict[str, RangeSum]) -> DataFrame:
    """(series..., t, _k, sums): one row for every grid time of
    ``range_segments``.  Times without a sample in any range have sums of 0."""
    every = range_segments(samples, series, ts, step_s, sums).withColumn("_at", F.explode(F.sequence("_k", "_last")))
    return every.select(*series, from_epoch_us(F.col("_at") * F.lit(step_s * 1_000_000)).alias("t"),
                        F.col("_at").alias("_k"), *sums)


def rule_intervals(frames: DataFrame, series: list[str], step_s: int, rules: list[AlertRule]) -> DataFrame:
    """(series..., alertname, pending_at, firing_at, resolved_at) of all rules:
    runs of grid times at which a rule's condition holds, for at least its
    time; resolved one step after the last.  ``frames`` are grid times or
    segments of them.  A series without a name (null) has no alerts."""
    size = step_s * 1_000_000
    last = F.col("_last") if "_last" in frames.columns else F.col("_k")
    true = F.array_compact(F.array(*[F.when(r.condition, F.lit(r.name)) for r in rules]))
    named = frames.dropna(subset=series)
    rows = named.select(*series, "_k", last.alias("_last"), F.explode(true).alias("alertname"))
    order = Window.partitionBy(*series, "alertname").orderBy("_k")
    opens = F.coalesce(F.col("_k") > F.lag("_last").over(order) + 1, F.lit(True))
    runs = (rows.withColumn("_opens", opens.cast("int"))
            .withColumn("_run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*series, "alertname", "_run")
            .agg((F.min("_k") * size).alias("start_us"), (F.max("_last") * size).alias("end_us")))
    hold = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.for_s * 1_000_000)]),
                        F.col("alertname"))
    runs = runs.withColumn("_for", hold.cast("long")).filter(F.col("end_us") - F.col("start_us") >= F.col("_for"))
    return runs.select(*series, "alertname", from_epoch_us(F.col("start_us")).alias("pending_at"),
                       from_epoch_us(F.col("start_us") + F.col("_for")).alias("firing_at"),
                       from_epoch_us(F.col("end_us") + size).alias("resolved_at"))


def routed_alerts(intervals: DataFrame, series: list[str], rules: list[AlertRule],
                  source: str = "critical", target: str = "warning") -> DataFrame:
    """Intervals with severity and summary; those of severity ``target`` go
    while one of severity ``source`` fires on the same series."""
    def of(field):
        return F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.name, getattr(r, field))]),
                            F.col("alertname"))
    a = intervals.withColumn("severity", of("severity")).withColumn("summary", of("summary"))
    kept = inhibit(a.filter(F.col("severity") == target), a.filter(F.col("severity") == source), series,
                   start="firing_at", end="resolved_at")
    return a.filter(F.col("severity") != target).unionByName(kept)
