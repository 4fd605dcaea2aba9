"""Chat formatting with cumulative-snapshot collapse.

Logs hold a conversation again and again as it grows.  Every turn gets a hash
of the turns up to it (its place, role and text), kept rolling along the
conversation in two levels: turns are range-sorted, so a long conversation lies
in several ranges, and a range's numbers and hashes go on from those of the
ranges before it.  A conversation whose last prefix hash is an inner prefix
hash of another one is an earlier snapshot of it and goes (an anti-join on
pre-aggregated, hence distinct, hashes); of equal conversations the smallest id
stays.  Only what is left is rendered.  DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: The markup of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, key, part, at, role, text, b1, b2): distinct turns, written
    once in order of conversation, turn, role and text.  ``at`` numbers the
    rows of a range (``part``) without gaps; ``key`` is the id as text, which a
    null id has too, so that joins and groups on it share one shuffle; ``b1``,
    ``b2`` hash role and text.  A turn that repeats another one in every column
    was logged twice and counts once."""
    key = ["conv_id", "turn", "role", "text"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # nulls would be skipped by the hash: say which columns are null
    parts = (F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))
    # the id only numbers sorted rows; where the ranges are cut changes no result
    return written(
        turns.select(*key).dropDuplicates(key).repartitionByRange(n, *key).sortWithinPartitions(*key)
        .withColumn("at", F.monotonically_increasing_id())
        .select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
                F.shiftright("at", 33).cast("int").alias("part"), "at", "role", "text",
                F.xxhash64(*parts).alias("b1"), F.xxhash64(F.lit("second"), *parts).alias("b2")),
        "chat-turns")


def _on_piece(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rows with the columns of their conversation's piece in their range."""
    return rows.join(pieces, ["key", "part"])


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """``ordered_turns`` -> (conv_id, k, n, h1, h2): the number of the turns so
    far and of all turns, and the rolling hash (two 64-bit words) so far."""
    # a conversation has at most one piece a range
    along = Window.partitionBy("key").orderBy("part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    pieces = (turns.groupBy("key", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m"))
              .select("key", "part", "first", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("skip"),
                      F.sum("m").over(Window.partitionBy("key")).alias("n")))
    run = (Window.partitionBy("key", "part").orderBy("k")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    t = (_on_piece(turns.select("conv_id", "key", "part", "at", "b1", "b2"), pieces)
         .withColumn("k", F.col("at") - F.col("first") + F.col("skip") + 1)
         .withColumn("t1", F.xxhash64("k", "b1")).withColumn("t2", F.xxhash64("k", "b2")))
    t = written(t.select("conv_id", "key", "part", "k", "n", "t1", "t2", F.bit_xor("t1").over(run).alias("l1"),
                         F.bit_xor("t2").over(run).alias("l2")), "chat-prefixes")
    totals = (t.groupBy("key", "part").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
              .select("key", "part", F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("o1"),
                      F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("o2")))
    return _on_piece(t, totals).select("conv_id", "k", "n", F.col("l1").bitwiseXOR(F.col("o1")).alias("h1"),
                                       F.col("l2").bitwiseXOR(F.col("o2")).alias("h2"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id of every conversation that is neither an earlier snapshot of a
    longer one nor a copy of one with a smaller id."""
    finals = (prefixes.filter("k = n").groupBy("k", "h1", "h2")
              .agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("id"))
              .select("k", "h1", "h2", F.col("id.conv_id").alias("conv_id")))
    # prefixes that some conversation goes beyond
    inner = (prefixes.filter("k < n").groupBy("k", "h1", "h2").agg(F.count(F.lit(1)).alias("longer"))
             .select("k", "h1", "h2"))
    return finals.join(inner, ["k", "h1", "h2"], "left_anti").select("conv_id", F.col("k").alias("n_turns"))


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per maximal conversation: (conv_id, n_turns, rendered).

    Turns are ordered by turn, then role and text on ties.  A null role
    renders as "unknown", a null text as empty; empty texts are turns.  Rows
    with a null conv_id form one conversation of their own.  Repeated rows
    collapse.  Other columns, whatever their names, are left behind.
    """
    turns = conversations.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"))
    turns = ordered_turns(turns)
    keep = maximal_conversations(turn_prefixes(turns)).select(F.col("conv_id").alias("cid"), "n_turns")
    kept = (turns.select("conv_id", "key", "part").distinct()
            .join(keep, F.col("conv_id").eqNullSafe(F.col("cid"))).select("key", "part", "n_turns"))
    line = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
                    F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n"))
    in_order = lambda at, x: F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct(at, x))), lambda r: r[x]), "")
    # a range's turns first, so that only the ranges of a conversation meet
    return (_on_piece(turns.select("conv_id", "key", "part", "at", line.alias("line")), kept)
            .groupBy("key", "part", "conv_id")
            .agg(F.max("n_turns").alias("n_turns"), in_order("at", "line").alias("lines"))
            .groupBy("conv_id")
            .agg(F.max("n_turns").cast("long").alias("n_turns"), in_order("part", "lines").alias("rendered")))
