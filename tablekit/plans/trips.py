"""Z1 trip cleansing on the driver's tables, and its stages as queries.

Stand-ins (FIXTURES.md §3): a trip is a ``lineitem`` row; key = (l_orderkey,
l_partkey, l_suppkey, l_linenumber); distance = l_quantity - 1; passengers =
nullif(l_linenumber, 7); pickup = o_orderdate of the order, dropoff =
l_shipdate; zone = supplier, of which only suppliers with a positive balance
are in the lookup (so some trips find no zone); duplicates come from a
union of the trips with themselves.

Plan shape (see ``trip_frames``): scan with the schema imposed on read ->
union -> drop incomplete rows -> dedup on the key (partial aggregation in
every task, so copies of a hot key collapse before the shuffle) -> attach the
pickup time from ``orders`` (a shuffle join on the order key; AQE splits a
hot order key) -> positive filter -> broadcast join of the size-checked zone
lookup -> native speed expression -> non-null filter.  The pickup is a
function of the order key, which is part of the dedup key, so dropping rows
without pickup after the dedup gives the same rows as before it and lets the
dedup shrink the data before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.scalars import duration_hours, safe_ratio
from tablekit.operators.aggs import key_dedup, observe_count, stage_funnel
from tablekit.operators.joins import broadcast_left_join
from tablekit.operators.shape import dropna_subset, not_null_filter, positive_filter, prefix_rename
from tablekit.operators.udfs import speed_udf
from tablekit.registry import query, table, scratch_dir_for
from tablekit.sources.files import scan_parquet_glob
from tablekit.sources.sinks import sink_parquet

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType())])

TRIP_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
REQUIRED = ["dropoff", "passengers", "distance", "zone"]


def trip_rows(lineitem: DataFrame) -> DataFrame:
    """Trip columns that are NOT functions of the key (carried by the dedup)."""
    return lineitem.select(
        *TRIP_KEY,
        (F.col("l_quantity") - 1).alias("distance"),
        F.col("l_shipdate").alias("dropoff"),
        F.col("l_extendedprice").alias("fare"))


def with_key_derived(df: DataFrame) -> DataFrame:
    """Trip columns that are functions of the key: computed, not carried."""
    return df.withColumns({"passengers": F.nullif(F.col("l_linenumber"), F.lit(7)),
                           "zone": F.col("l_suppkey")})


def zone_lookup(supplier: DataFrame) -> DataFrame:
    active = supplier.filter(F.col("s_acctbal") > 0).select("s_suppkey", "s_name", "s_nationkey")
    return prefix_rename(active, "", {"s_suppkey": "zone", "s_name": "zone_name",
                                      "s_nationkey": "zone_nation"})


def trip_frames(spark: SparkSession, sf_dir: str, observe: bool = False) -> dict:
    """All stages of the trip cleansing as lazy frames (and observations)."""
    obs = {}
    li = scan_parquet_glob(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA)
    trips = trip_rows(li)
    raw = trips.unionByName(trips)
    if observe:
        raw, obs["ingest"] = observe_count(raw, "ingest")
    # the NULL check covers key-derived columns too (it becomes a filter on
    # the key columns); those columns are not carried through the dedup's
    # aggregate but derived again after it, which keeps the sorted struct narrow
    complete = dropna_subset(with_key_derived(raw), REQUIRED).drop("passengers", "zone")
    dedup = with_key_derived(key_dedup(complete, TRIP_KEY))
    pickup = (table(spark, sf_dir, "orders")
              .select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("pickup"))
              .filter(F.col("pickup").isNotNull()))
    cleaned = positive_filter(dedup.join(pickup, on="l_orderkey", how="inner"),
                              ["distance", "passengers"])
    if observe:
        cleaned, obs["cleanse"] = observe_count(cleaned, "cleanse")
    joined = broadcast_left_join(cleaned, zone_lookup(table(spark, sf_dir, "supplier")), "zone")
    if observe:
        joined, obs["join"] = observe_count(joined, "join")
    speed = safe_ratio(F.col("distance"), duration_hours("pickup", "dropoff"))
    final = not_null_filter(joined.withColumn("avg_speed", speed), "avg_speed")
    return {"raw": raw, "cleaned": cleaned, "joined": joined, "final": final, "obs": obs}


def trip_output(final: DataFrame) -> DataFrame:
    return final.select(*TRIP_KEY, "pickup", "dropoff", "passengers", "distance", "fare",
                        "zone", "zone_name", "zone_nation",
                        F.round("avg_speed", 4).alias("avg_speed"))


def run_trip_job(spark: SparkSession, sf_dir: str, out: str) -> dict:
    """The whole job as ONE action (the write); stage counts come from
    observations on the same run."""
    fr = trip_frames(spark, sf_dir, observe=True)
    fin, obs_final = observe_count(trip_output(fr["final"]), "final")
    sink_parquet(fin, out)
    counts = {k: o.get["rows"] for k, o in fr["obs"].items()}
    counts["final"] = obs_final.get["rows"]
    return counts


_TRIPS_SQL = """
WITH t AS (
  SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         l_quantity - 1 AS distance, NULLIF(CAST(l_linenumber AS BIGINT), 7) AS passengers,
         l_shipdate AS dropoff, l_suppkey AS zone, l_extendedprice AS fare
  FROM lineitem),
raw AS (SELECT * FROM t UNION ALL SELECT * FROM t),
complete AS (
  SELECT * FROM raw
  WHERE dropoff IS NOT NULL AND passengers IS NOT NULL AND distance IS NOT NULL
    AND NOT isnan(distance) AND zone IS NOT NULL),
dedup AS (
  SELECT * FROM complete
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber
                             ORDER BY distance NULLS FIRST, passengers NULLS FIRST,
                                      dropoff NULLS FIRST, zone NULLS FIRST, fare NULLS FIRST) = 1),
cleaned AS (
  SELECT d.*, o.o_orderdate AS pickup
  FROM dedup d JOIN orders o ON o.o_orderkey = d.l_orderkey
  WHERE o.o_orderdate IS NOT NULL AND d.distance > 0 AND d.passengers > 0),
joined AS (
  SELECT c.*, s.s_name AS zone_name, s.s_nationkey AS zone_nation
  FROM cleaned c LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = c.zone),
speed AS (
  SELECT *, CASE WHEN distance > 0 AND h > 0 THEN distance / h END AS avg_speed
  FROM (SELECT *, (epoch_us(dropoff) - epoch_us(pickup)) / 3.6e9 AS h FROM joined))
"""


@query("trip_cleanse", sql=_TRIPS_SQL + """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, pickup, dropoff, passengers, distance,
       fare, zone, zone_name, zone_nation, round(avg_speed, 4) AS avg_speed
FROM speed WHERE avg_speed IS NOT NULL
""")
def q_trip_cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_output(trip_frames(spark, sf_dir)["final"])


@query("stage_funnel", sql=_TRIPS_SQL + """
SELECT 'ingest' AS stage, 0 AS ordinal, count(*) AS rows FROM raw
UNION ALL SELECT 'cleanse', 1, count(*) FROM cleaned
UNION ALL SELECT 'join', 2, count(*) FROM joined
UNION ALL SELECT 'final', 3, count(*) FROM speed WHERE avg_speed IS NOT NULL
""")
def q_stage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each stage.  Row-predicate stages share one pass:
    join and final come from one aggregate with a ``count_if`` flag; the
    scans and the dedup exchange under the stages are reused by the planner."""
    fr = trip_frames(spark, sf_dir)
    flagged = fr["joined"].withColumn(
        "_ok", safe_ratio(F.col("distance"), duration_hours("pickup", "dropoff")).isNotNull())
    jf = flagged.agg(F.count(F.lit(1)).alias("join"), F.count_if("_ok").alias("final")).selectExpr(
        "stack(2, 'join', 2, `join`, 'final', 3, `final`) AS (stage, ordinal, rows)")
    head = stage_funnel([("ingest", fr["raw"]), ("cleanse", fr["cleaned"])])
    return head.unionByName(jf)


def _speed_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        *TRIP_KEY, (F.col("l_quantity") - 1).alias("distance"),
        F.col("o_orderdate").alias("pickup"), F.col("l_shipdate").alias("dropoff"))


_SPEED_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       round(CASE WHEN distance > 0 AND h > 0 THEN distance / h END, 4) AS avg_speed
FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity - 1 AS distance,
             (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 AS h
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


@query("pandas_udf_speed", sql=_SPEED_SQL)
def q_pandas_udf_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectorised UDF; must agree with the native ``safe_speed``."""
    d = _speed_inputs(spark, sf_dir)
    return d.select(*TRIP_KEY, F.round(speed_udf("distance", "pickup", "dropoff"), 4)
                    .alias("avg_speed"))


@query("safe_ratio", sql=_SPEED_SQL)
def q_safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + X1: the native twin of the UDF."""
    d = _speed_inputs(spark, sf_dir)
    return d.select(*TRIP_KEY, F.round(safe_ratio(F.col("distance"),
                                                  duration_hours("pickup", "dropoff")), 4)
                    .alias("avg_speed"))


@query("duration_hours", sql="""
SELECT l_orderkey, l_linenumber,
       round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9, 4) AS hours
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def q_duration_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", F.col("l_linenumber"),
        F.round(duration_hours("o_orderdate", "l_shipdate"), 4).alias("hours"))


# ------------------------------------------------------------ S3 / S4 / U1
def write_drifting_slices(spark: SparkSession, sf_dir: str) -> str:
    """Derive three drifting files from ``lineitem`` by return flag: 'A' as
    is, 'N' with l_linenumber widened to long and l_tax dropped, 'R' with a
    column name in another case.  Written once per call to the shared folder."""
    li = table(spark, sf_dir, "lineitem")
    base = scratch_dir_for(spark, "drift")
    li.filter(F.col("l_returnflag") == "A").write.parquet(f"{base}/part-a.parquet")
    (li.filter(F.col("l_returnflag") == "N")
       .withColumn("l_linenumber", F.col("l_linenumber").cast("long")).drop("l_tax")
       .write.parquet(f"{base}/part-n.parquet"))
    (li.filter(F.col("l_returnflag") == "R").withColumnRenamed("l_quantity", "L_Quantity")
       .write.parquet(f"{base}/part-r.parquet"))
    return base


_DRIFT_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_quantity, l_extendedprice, l_discount,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_tax END AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R')
"""


@query("scan_parquet_glob", sql=_DRIFT_SQL)
def q_scan_parquet_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: one scan over a glob, canonical schema imposed on read."""
    base = write_drifting_slices(spark, sf_dir)
    return scan_parquet_glob(spark, f"{base}/part-*.parquet", LINEITEM_SCHEMA)


@query("schema_normalize", sql=_DRIFT_SQL)
def q_schema_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + U1: per-file normalisation then union by name."""
    from tablekit.sources.files import scan_parquet_files
    base = write_drifting_slices(spark, sf_dir)
    files = [f"{base}/part-{x}.parquet" for x in ("a", "n", "r")]
    return scan_parquet_files(spark, files, LINEITEM_SCHEMA)


@query("union_by_name", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, NULL::DOUBLE AS l_tax, l_linestatus
FROM lineitem WHERE l_linestatus = 'O'
UNION ALL
SELECT l_orderkey, l_linenumber, NULL::DOUBLE AS l_quantity, l_tax, l_linestatus
FROM lineitem WHERE l_linestatus <> 'O'
""")
def q_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open and finished lines come as two tables with different columns;
    bag union by name with missing columns as NULL."""
    li = table(spark, sf_dir, "lineitem")
    open_ = li.filter(F.col("l_linestatus") == "O").select("l_orderkey", "l_linenumber",
                                                             "l_quantity", "l_linestatus")
    done = li.filter(F.col("l_linestatus") != "O").select("l_orderkey", "l_linenumber",
                                                            "l_tax", "l_linestatus")
    return open_.unionByName(done, allowMissingColumns=True).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_linestatus")


@query("sink_parquet", sql="""
SELECT l_returnflag, count(*) AS rows, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY l_returnflag
""")
def q_sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: write ``lineitem`` partitioned by flag and read it back."""
    path = scratch_dir_for(spark, "lineitem_out")
    sink_parquet(table(spark, sf_dir, "lineitem"), path, partition_by=["l_returnflag"])
    back = spark.read.parquet(path)
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"),
                                            F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
