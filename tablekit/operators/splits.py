"""Ranks, splits, sampling and orderings.

Exact ranks never go through a single task: ``group_rank`` cuts every group
into value buckets of its order key (quantile bounds per group), so one group
holding a third of all rows is spread over many tasks, numbers rows locally,
and adds the row counts of the earlier buckets of the same group (a table of
at most buckets x groups rows).  Randomness is an md5 of (seed, key): the same in any partition layout
and in any engine that has md5.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.operators.joins import bounded_broadcast
from tablekit.session import ensure_checkpoint_dir


_EPOCH = _dt.datetime(1970, 1, 1)


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# ---------------------------------------------------------------- hashing
def seeded_hash(seed: int | str, key: Column | str) -> Column:
    """Hex md5 of "seed|key": a repeatable random order key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.lit(str(seed)), k.cast("string")))


def seeded_uniform(seed: int | str, key: Column | str, salt: str = "") -> Column:
    """Uniform [0, 1) double from the md5 of (seed, salt, key)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), k.cast("string")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


# ---------------------------------------------------------------- exact ranks
def _order_proxy(df: DataFrame, c: str) -> Column | None:
    """A double that never decreases when ``c`` increases (ascending order),
    or None when the type has no such cheap proxy."""
    t = df.schema[c].dataType
    x = F.col(c)
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                      T.DoubleType, T.DecimalType)):
        return x.cast("double")
    if isinstance(t, T.BooleanType):
        return x.cast("int").cast("double")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                x.cast("timestamp_ntz")).cast("double")
    if isinstance(t, T.StringType):
        # first 7 bytes, zero-padded, read as a number: byte order = string order
        return F.conv(F.rpad(F.hex(F.substring(x, 1, 7)), 14, "0"), 16, 10).cast("double")
    return None


def _combine(agg: str, inclusive: bool) -> Column:
    if agg == "sum" and not inclusive:
        return F.when(F.col("_off").isNull() & F.col("_lsum").isNull(), F.lit(None)).otherwise(
            F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.col("_lsum"), F.lit(0)))
    if agg == "sum":
        return F.coalesce(F.col("_off"), F.lit(0)) + F.col("_lsum")
    return F.greatest(F.col("_off"), F.col("_lsum"))  # greatest skips NULL


def group_running_sum(df: DataFrame, order: list, value: Column | str | None = None,
                      group: list[str] | None = None, name: str = "running",
                      partitions: int | None = None, agg: str = "sum",
                      inclusive: bool = True, materialize: bool = True) -> DataFrame:
    """Running sum (or max, ``agg="max"``) of ``value`` (default 1, i.e. the
    row number) within ``group`` in ascending ``order``, rows unbounded
    preceding to the current row (``inclusive=False``: up to the previous
    row; NULL for the first row of a group).

    ``order`` must be a total order (end it with a unique key) for the result
    to be repeatable.  Rows are cut into value buckets of the first order
    column: approximate quantile bounds of that column (one row of
    buckets - 1 values, checkpointed once so every branch sees the same
    bounds, broadcast with a proven size) give each row a bucket that only
    depends on its own value.  A group holding a third of all rows also
    shapes a third of the quantiles, so it spans many buckets.  One exchange on
    (group, bucket) then carries the local running sums; the bucket totals
    (read from the same exchange) give each bucket the sum of the earlier
    buckets of its group.  A group holding a third of all rows is spread over
    all buckets; no single task sees it whole and no driver collect happens.

    ``materialize`` (default) writes the input once as a reliable checkpoint
    in the shared checkpoint folder, so the bounds, the running sums and the
    totals read it instead of re-running a deep lineage three times; pass
    False when the input is a plain table scan (re-reading it is cheaper).
    """
    group = group or []
    first = order[0] if order else None
    proxy = _order_proxy(df, first) if isinstance(first, str) and first in df.columns else None
    if proxy is None:
        return _group_running_sum_ranged(df, order, value, group, name, partitions, agg, inclusive)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    okeys = _cols(order)
    v = F.lit(1).cast("long") if value is None else (
        F.col(value) if isinstance(value, str) else value)
    x = df.withColumn("_v", v).withColumn("_px", proxy)
    if materialize:
        x = x.checkpoint(eager=True)
    qs = [i / n for i in range(1, n)]
    bounds = x.agg(F.percentile_approx("_px", qs, 10000).alias("_bounds")).checkpoint(eager=True)
    if len(order) > 1:
        # equal neighbouring bounds: one value of the first column holds at
        # least 1 / n of all rows and would fill one bucket (one task).  The
        # range-partitioned path splits such ties by the later order columns.
        # Reads one row of n - 1 doubles.
        b = bounds.first()["_bounds"] or []
        if any(lo == hi for lo, hi in zip(b, b[1:])):
            return _group_running_sum_ranged(x.drop("_v", "_px"), order, value, group, name,
                                             partitions, agg, inclusive)
    xb = x.crossJoin(F.broadcast(bounds))  # one row of n - 1 doubles
    # bucket = number of bounds below the value, by bisection in steps of
    # powers of two: one expression whose depth does not grow with n
    steps = [1 << i for i in range(max(1, n).bit_length() - 1, -1, -1)]
    bucket = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get("_bounds", at + step - 1) < F.col("_px"), at + step)
        .otherwise(at))
    xb = xb.withColumn("_bk", bucket).drop("_bounds", "_px")
    fn = F.sum if agg == "sum" else F.max
    wl = (Window.partitionBy(*group, "_bk").orderBy(*okeys)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    local = xb.withColumn("_lsum", fn("_v").over(wl))
    totals = local.groupBy(*group, "_bk").agg(fn("_v").alias("_tot"))
    wo = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, "_bk", fn("_tot").over(wo).alias("_off"))
    # no size probe here (it would be a job re-running the input): the big
    # side is already hash-partitioned and sorted on (group, bucket), so a
    # sort-merge join only moves the small offsets table, and AQE turns it
    # into a broadcast from the measured size when that is smaller
    out = local.join(offsets, on=[*group, "_bk"], how="inner")
    return out.withColumn(name, _combine(agg, inclusive)).drop("_bk", "_lsum", "_off", "_v")


def _group_running_sum_ranged(df: DataFrame, order: list, value, group: list[str], name: str,
                              partitions: int | None, agg: str, inclusive: bool) -> DataFrame:
    """Fallback for orders without a numeric proxy (descending columns,
    expressions): range shuffle on (group, order), partition ids fixed by a
    reliable checkpoint, local running sums, offsets of earlier partitions."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    okeys = _cols(order)
    v = F.lit(1).cast("long") if value is None else (
        F.col(value) if isinstance(value, str) else value)
    ranged = (df.withColumn("_v", v)
                .repartitionByRange(n, *_cols(group), *okeys)
                .withColumn("_pid", F.spark_partition_id())
                .checkpoint(eager=True))
    wl = (Window.partitionBy("_pid", *group).orderBy(*okeys)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    fn = F.sum if agg == "sum" else F.max
    local = ranged.withColumn("_lsum", fn("_v").over(wl))
    totals = ranged.groupBy(*group, "_pid").agg(fn("_v").alias("_tot"))
    wo = (Window.partitionBy(*group).orderBy("_pid")
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*group, "_pid", fn("_tot").over(wo).alias("_off"))
    out = local.join(bounded_broadcast(offsets), on=[*group, "_pid"], how="inner")
    return out.withColumn(name, _combine(agg, inclusive)).drop("_pid", "_lsum", "_off", "_v")


def group_rank(df: DataFrame, order: list, group: list[str] | None = None,
               name: str = "rank", partitions: int | None = None,
               materialize: bool = True) -> DataFrame:
    """1-based row number within ``group`` (or over all rows) by ``order``,
    computed without a single-task window (see ``group_running_sum``)."""
    return group_running_sum(df, order, None, group, name, partitions,
                             materialize=materialize).withColumn(name, F.col(name).cast("long"))


def next_row(df: DataFrame, order: list, group: list[str], cols: list[str],
             prefix: str = "next_") -> DataFrame:
    """Columns of the next row in ``order`` within ``group`` (a skew-safe
    ``lead``): rank the rows, then an equi join of rank r to rank r + 1."""
    r = group_rank(df, order, group, name="_r")
    nxt = r.select(*group, (F.col("_r") - 1).alias("_r"),
                   *[F.col(c).alias(prefix + c) for c in cols])
    return r.join(nxt, on=[*group, "_r"], how="left").drop("_r")


def group_sizes(df: DataFrame, group: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))


# ---------------------------------------------------------------- W1 / T2
def position_slice(df: DataFrame, order: list, start: int, stop: int) -> DataFrame:
    """Rows [start, stop) of the table in ``order`` (0-based, half-open)."""
    r = group_rank(df, order, name="_pos")
    return r.filter((F.col("_pos") > start) & (F.col("_pos") <= stop)).drop("_pos")


def fraction_slice(df: DataFrame, order: list, lo: float, hi: float) -> DataFrame:
    """Rows at positions [floor(lo * n), floor(hi * n)) of the table in
    ``order``: the positional slice stated as shares, so it grows with the
    table (rows 7000-8000 of 10,000 are the shares 0.7-0.8)."""
    r = group_rank(df, order, name="_pos")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    j = r.crossJoin(F.broadcast(n))  # one-row side
    return j.filter((F.col("_pos") > F.floor(F.col("_n") * lo))
                    & (F.col("_pos") <= F.floor(F.col("_n") * hi))).drop("_pos", "_n")


def first_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in ``order``: Catalyst's top-k (each task keeps n)."""
    return df.orderBy(*_cols(order)).limit(n)


# ---------------------------------------------------------------- T1 / T4 / T5
def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "shuffle_key") -> DataFrame:
    """Adds the order key of a repeatable shuffle; sort by it when needed."""
    return df.withColumn(name, seeded_hash(seed, key))


def sample_rows(df: DataFrame, key: str, n: int = 8, seed: int = 42) -> DataFrame:
    """``n`` rows of the seeded shuffle (a sampling operator: the limit is the
    feature)."""
    return df.orderBy(seeded_hash(seed, key), F.col(key)).limit(n)


# ---------------------------------------------------------------- W3
def label_encode(df: DataFrame, col: str, name: str | None = None,
                 null_code: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Sorted distinct labels to 0..k-1; returns (encoded rows, label map).

    The map is built from the distinct values (ranked without a single-task
    window) and joined back; NULL gets ``null_code`` (pandas' -1) or stays
    NULL.  Pass the map to ``apply_label_map`` to encode other data alike.
    """
    name = name or f"{col}_code"
    labels = df.select(col).filter(F.col(col).isNotNull()).distinct()
    m = group_rank(labels, [col], name="_r").select(col, (F.col("_r") - 1).cast("int").alias(name))
    return apply_label_map(df, m, col, name, null_code), m


def apply_label_map(df: DataFrame, label_map: DataFrame, col: str, name: str,
                    null_code: int | None = None) -> DataFrame:
    out = df.join(bounded_broadcast(label_map), on=col, how="left")
    if null_code is not None:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(null_code)))
    return out


# ---------------------------------------------------------------- W2
def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.1,
                     val_frac: float = 0.2, seed: int = 42, split: str = "split") -> DataFrame:
    """Per-class split: test = max(1, round(test_frac * n)) rows of the class,
    validation = max(1, round(val_frac * (n - test))) of the rest, the rest
    train, in the class's seeded-hash order.  Every class of 3 or more rows
    lands in all three splits; repeatable in any layout."""
    h = seeded_hash(seed, key)
    r = group_rank(df.withColumn("_h", h), ["_h", key], group=[label], name="_r")
    sizes = group_sizes(df, [label], "_n")
    j = r.join(bounded_broadcast(sizes), on=label, how="inner")
    n_test = F.greatest(F.lit(1), F.round(F.col("_n") * test_frac).cast("long"))
    n_val = F.greatest(F.lit(1), F.round((F.col("_n") - n_test) * val_frac).cast("long"))
    s = (F.when(F.col("_r") <= n_test, "test")
          .when(F.col("_r") <= n_test + n_val, "val").otherwise("train"))
    return j.withColumn(split, s).drop("_h", "_r", "_n")


# ---------------------------------------------------------------- M1
def exact_random_split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42,
                       split: str = "split") -> DataFrame:
    """Seeded split with exact size: the ceil(test_frac * n) rows first in
    the seeded-hash order are test."""
    r = group_rank(df.withColumn("_h", seeded_hash(seed, key)), ["_h", key], name="_r")
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    j = r.crossJoin(n)  # one-row side
    s = F.when(F.col("_r") <= F.ceil(F.col("_n") * test_frac), "test").otherwise("train")
    return j.withColumn(split, s).drop("_h", "_r", "_n")


# ---------------------------------------------------------------- W11
def batch_ids(df: DataFrame, order: list, batch: int, name: str = "batch_id") -> DataFrame:
    """Consecutive groups of ``batch`` rows in ``order`` (use the seeded
    shuffle key for shuffled batches)."""
    r = group_rank(df, order, name="_r")
    return r.withColumn(name, F.floor((F.col("_r") - 1) / batch).cast("long")).drop("_r")


# ---------------------------------------------------------------- J8
def weighted_resample(df: DataFrame, label: str, key: str, num_samples: int | None = None,
                      seed: int = 42) -> DataFrame:
    """Draw rows with replacement so that classes come out even (row weight
    1 / class size): draw a class uniformly, then a row uniformly in the
    class, both from md5 of (seed, draw id).  Draws join rows on
    (class, row number): an equi join, no range join, no cumulative sum.
    Default ``num_samples`` = number of rows."""
    spark = df.sparkSession
    codes = group_rank(df.select(label).distinct(), [label], name="_c")
    sizes = group_sizes(df, [label], "_n").join(codes, on=label)
    k = codes.agg(F.count(F.lit(1)).alias("_k"))
    total = df.agg(F.count(F.lit(1)).alias("_N"))
    draws = spark.range(num_samples) if num_samples else None
    if draws is None:
        # one draw per row; ids 0..N-1 are the rows' ranks, no driver count
        draws = group_rank(df.select(key), [key], name="_d").select((F.col("_d") - 1).alias("id"))
    d = (draws.crossJoin(k)
              .withColumn("_c", (F.floor(seeded_uniform(seed, "id", "class") * F.col("_k")) + 1)
                          .cast("long")))
    d = d.join(bounded_broadcast(sizes), on="_c", how="inner")
    d = d.withColumn("_rn", (F.floor(seeded_uniform(seed, "id", "row") * F.col("_n")) + 1)
                     .cast("long")).select(F.col("id").alias("draw_id"), label, "_rn")
    rows = group_rank(df, [key], group=[label], name="_rn")
    _ = total
    return d.join(rows, on=[label, "_rn"], how="inner").drop("_rn")
