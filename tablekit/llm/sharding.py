"""Sharding over fixed virtual slots.

Rows hash into SLOTS virtual slots, once and for all.  A versioned table maps
slots to shards; balancing edits the map, never the hash, so a row moves only
if its slot does.  Bytes and rows are summed per slot (SLOTS rows at any input
size); the driver moves and swaps slots until the shards' bytes are even and
stores the result as the next version.  A row's place in its shard is its
slot's offset there plus its rank within the slot, so no task ever sorts a
whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.session import scratch_path

from .common import repeated, texts

SLOTS = 4096
LAW = "bytes"


def rows_with_slots(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, d, th, size, text_crc32, copy, virtual_slot).  Size: UTF-8
    bytes of the text plus one; a null text has no bytes.  The slot depends on
    id, text and, of equal rows, the copy's number, so rows without an id and
    rows that are repeated spread as well.  Equal rows are counted, not
    numbered by a window, and dealt out again in blocks."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = texts(docs, id_col, text_col).select(
        "doc_id", "d", "th", (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"))
    told = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    one = told.filter("n = 1").select(*rows.columns, F.lit(0).cast("long").alias("copy"))
    many = repeated(told.filter("n > 1"), "n", "copy").select(*rows.columns, "copy")
    return one.unionByName(many).withColumn(
        "virtual_slot", F.pmod(F.xxhash64("d", "th", "copy"), F.lit(slots)).cast("int"))


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows per slot."""
    got = (rows.groupBy("virtual_slot")
           .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect())
    size, count = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for r in got:
        size[r["virtual_slot"]], count[r["virtual_slot"]] = r["bytes"], r["rows"]
    return size, count


def initial_map(shards: int, slots: int = SLOTS) -> np.ndarray:
    """Version 1, before any load is known: slots dealt in turn."""
    return np.arange(slots) % shards


def rebalance(slot_shard: np.ndarray, load: np.ndarray, shards: int) -> np.ndarray:
    """Edit the map until no single move or swap of slots between a full and
    one of the emptiest shards narrows their difference.  A shard that one
    huge slot fills is left alone and the others go on.  Shards may be added
    (they start empty)."""
    out = slot_shard.copy()
    total = np.bincount(out, weights=load, minlength=shards)
    stuck = np.zeros(len(total), bool)
    for _ in range(20 * len(out)):
        if stuck.all():
            break
        top = int(np.where(stuck, -1, total).argmax())
        mine = np.flatnonzero((out == top) & (load > 0))
        best = None  # (remaining gap, slot, slot back, other shard)
        for other in np.argsort(total, kind="stable")[:4].tolist():
            gap = total[top] - total[other]
            if other == top or gap <= 0:
                continue
            theirs = np.flatnonzero((out == other) & (load > 0))
            sizes = np.concatenate([[0], load[theirs]])
            order = np.argsort(sizes, kind="stable")
            # moving x and taking y back leaves |gap - 2 (x - y)|
            want = load[mine] - gap / 2
            k = np.searchsorted(sizes[order], want)
            for j in (np.clip(k, 0, len(order) - 1), np.clip(k - 1, 0, len(order) - 1)):
                y = sizes[order[j]]
                left = np.abs(gap - 2 * (load[mine] - y))
                if not len(left):
                    continue
                i = int(left.argmin())
                if left[i] < gap and (best is None or left[i] - gap < best[0]):
                    pick = int(order[j[i]])
                    best = (left[i] - gap, int(mine[i]), None if pick == 0 else int(theirs[pick - 1]), other)
        if best is None:
            stuck[top] = True
            continue
        _, x, y, other = best
        out[x] = other
        total[top] -= load[x]
        total[other] += load[x]
        if y is not None:
            out[y] = top
            total[top] += load[y]
            total[other] -= load[y]
    return out


def store_map(spark: SparkSession, path: str, version: int, slot_shard: np.ndarray,
              size: np.ndarray, count: np.ndarray) -> None:
    """Write one version of the map beside the earlier ones."""
    rows = [(version, i, int(s), int(b), int(n))
            for i, (s, b, n) in enumerate(zip(slot_shard, size, count))]
    (spark.createDataFrame(rows, "version int, virtual_slot int, shard int, bytes long, rows long")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}"))


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(virtual_slot, shard, bytes, rows, first): ``first`` is the place in
    the shard where the slot's rows begin."""
    m = spark.read.parquet(f"{path}/version={version}").select("virtual_slot", "shard", "bytes", "rows")
    w = Window.partitionBy("shard").orderBy("virtual_slot")
    return m.withColumn("first", F.sum("rows").over(w) - F.col("rows"))


def shard(docs: DataFrame, shards: int = 16, slots: int = SLOTS, path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, size, text_crc32, shard, slot,
    virtual_slot, version).

    ``slot`` counts a shard's rows from 0 without gaps.  Null ids and texts,
    empty texts (size 1) and repeated rows are rows like any other; equal rows
    lie in several virtual slots, by their copy number.  The maps (version 1 even, version 2 edited to
    even bytes) are stored under ``path``, by default in the shared folder.
    Other columns are left behind.
    """
    spark = docs.sparkSession
    rows = rows_with_slots(docs, slots, id_col, text_col)
    size, count = slot_loads(rows, slots)
    path = path or scratch_path(spark, "slot-map")
    first = initial_map(shards, slots)
    store_map(spark, path, 1, first, size, count)
    store_map(spark, path, 2, rebalance(first, size, shards), size, count)
    # ``slots`` rows: a fixed bound
    where = F.broadcast(load_map(spark, path, 2).select("virtual_slot", "shard", "first"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("d", "th", "copy"))
    return (rows.withColumn("rank", rank).join(where, "virtual_slot")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first") + F.col("rank") - 1).alias("slot"),
                    "virtual_slot", F.lit(2).alias("version")))
