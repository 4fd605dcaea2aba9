"""Joins (J1-J9).

Broadcast is used only behind a size check: ``bounded_broadcast`` reads at
most ``max_rows + 1`` rows of the small side (a bounded probe, never the whole
side) and estimates its bytes from the schema; past either bound the join is
left to the planner (shuffle hash / sort-merge join, AQE may still convert it
at run time from real statistics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed limits for a broadcast side: well under Spark's 8 GB hard cap and
# small enough to ship to every executor.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def _width(t: T.DataType) -> int:
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 64
    if isinstance(t, T.StructType):
        return sum(_width(f.dataType) for f in t.fields)
    if isinstance(t, (T.ArrayType, T.MapType)):
        return 256
    return 8


def row_width(schema: T.StructType) -> int:
    """Bytes per row besides the contents of strings and collections."""
    return _width(schema) + 16


def _content_bytes(schema: T.StructType) -> Column:
    """Bytes that the strings, binaries and collections of a row hold."""
    total = F.lit(0).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # the text form of most values is no shorter; 8 bytes a character
            total = total + 8 * F.coalesce(F.octet_length(c.cast("string")), F.lit(0))
    return total


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes,
    string and collection contents measured.  The probe stops after
    max_rows + 1 rows."""
    r = (df.limit(max_rows + 1).select(_content_bytes(df.schema).alias("_b"))
         .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_b"), F.lit(0)).alias("b")).first())
    return r["n"] <= max_rows and r["n"] * row_width(df.schema) + r["b"] <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when it fits, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


# ---------------------------------------------------------------- J1
def broadcast_left_join(fact: DataFrame, dim: DataFrame, on: str | list[str],
                        max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left join to a lookup table; unmatched fact rows keep NULL lookup
    columns.  Lookup keys must be unique or fact rows multiply."""
    return fact.join(bounded_broadcast(dim, max_rows), on=on, how="left")


# ---------------------------------------------------------------- J2
def label_lookup(df: DataFrame, label_map: DataFrame, label: str = "label",
                 code: str = "label_idx") -> DataFrame:
    """Label text to integer code through a (small, unique) label map."""
    return df.join(bounded_broadcast(label_map.select(label, code)), on=label, how="left")


# ---------------------------------------------------------------- J3
def vector_arith(df: DataFrame, keys: list[str], metric: str, value: str,
                 a: str, b: str, fn) -> DataFrame:
    """Sample-wise arithmetic of two metrics matched on all ``keys``.

    One grouped pass pivots the two metrics side by side (conditional
    aggregation, no self join); series where either side is missing drop out
    (inner semantics).  ``fn(a_col, b_col) -> Column``.
    """
    side = (df.filter(F.col(metric).isin(a, b))
              .groupBy(*keys)
              .agg(F.max(F.when(F.col(metric) == a, F.col(value))).alias("_a"),
                   F.max(F.when(F.col(metric) == b, F.col(value))).alias("_b")))
    return (side.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
                .select(*keys, fn(F.col("_a"), F.col("_b")).alias("value")))


# ---------------------------------------------------------------- J4
def inhibit(targets: DataFrame, sources: DataFrame, equal: list[str],
            start: str = "start", end: str = "end") -> DataFrame:
    """Drop target intervals that overlap a source interval with the same
    ``equal`` labels (``t.start < s.end and t.end > s.start``).

    A target overlaps some source iff the largest ``s.end`` among sources
    with ``s.start < t.end`` is above ``t.start``.  Sources and targets are put
    in one stream per label set, ordered by (source start | target end), and a
    running max of source ends answers every target: no pair of rows is ever
    formed, and the running max is range-partitioned, so a label set holding
    most intervals is sorted across many tasks (O(n log n), not n x m).
    """
    from tablekit.operators.splits import group_running_sum
    tcols = targets.columns
    t = targets.select(*[F.col(k) for k in equal],
                       F.col(end).alias("_k"), F.lit(0).alias("_kind"),
                       F.lit(None).cast(sources.schema[end].dataType).alias("_s_end"),
                       F.struct(*[F.col(f"`{c}`") for c in tcols]).alias("_row"))
    s = sources.select(*[F.col(k) for k in equal],
                       F.col(start).alias("_k"), F.lit(1).alias("_kind"),
                       F.col(end).alias("_s_end"),
                       F.lit(None).cast(t.schema["_row"].dataType).alias("_row"))
    # at equal key a target sorts first: a source starting exactly at t.end
    # does not overlap
    both = group_running_sum(t.unionByName(s), ["_k", "_kind"], "_s_end", equal,
                             name="_max_end", agg="max")
    kept = both.filter((F.col("_kind") == 0) & ~F.coalesce(
        F.col("_max_end") > F.col("_row").getField(start), F.lit(False)))
    return kept.select("_row.*")


# ---------------------------------------------------------------- J5
def full_class_join(class_map: DataFrame, per_class: DataFrame, on: str,
                    fill_cols: list[str]) -> DataFrame:
    """Every class of the map, with zero metrics when it has no rows."""
    j = class_map.join(per_class, on=on, how="left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in fill_cols})


# ---------------------------------------------------------------- J6
def side_by_side(left: DataFrame, right: DataFrame, lp: str = "a_", rp: str = "b_") -> DataFrame:
    """Put two one-row aggregates next to each other (a 1 x 1 cross join)."""
    lp_ = left.select(*[F.col(c).alias(lp + c) for c in left.columns])
    rp_ = right.select(*[F.col(c).alias(rp + c) for c in right.columns])
    return lp_.crossJoin(rp_)


# ---------------------------------------------------------------- J7
def run_compare(stages: DataFrame, base_run: str, run: str = "run", stage: str = "stage",
                sec: str = "sec") -> DataFrame:
    """Stages of every run against the same stage of ``base_run``: ratio and
    speed-up.  Equi join on stage; the base side is one row per stage."""
    base = (stages.filter(F.col(run) == base_run)
                  .select(F.col(stage), F.col(sec).alias("base_sec")))
    return (stages.join(base, on=stage, how="inner")
                  .withColumn("ratio", F.try_divide(F.col(sec), F.col("base_sec")))
                  .withColumn("speedup", F.try_divide(F.col("base_sec"), F.col(sec))))


# ---------------------------------------------------------------- J9
def alert_enrich(alerts: DataFrame, rules: DataFrame, on: str = "alertname") -> DataFrame:
    """Attach severity / summary / description of the rule to each alert."""
    return alerts.join(bounded_broadcast(rules), on=on, how="left")


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 < e2) & (e1 > s2)
