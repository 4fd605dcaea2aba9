"""Benchmark decontamination as a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item (a shorter item is
one window).  Its tokens are its SHINGLE-word runs.  A document holds the
window only if it holds all of the window's tokens, so with tokens ordered by
rarity (occurrences over all documents) the necessary prefix is the single
rarest one.  Documents are joined on these prefix tokens only; the positional
bound (the window must fit around the token's place) and the length bound cut
candidates before the words of the window are compared exactly.

Two fixed-size bit sets carry benchmark tokens to the document scans, so that
only document words at a benchmark token are ever shuffled; the joins settle
false positives.  The benchmark itself is joined, not broadcast by hint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, freed, strings, texts
from .words import BitSet, RangeHasher, bit_set, blocks, signed

SHINGLE = 5
BITS_LOG2 = 24


def item_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """(item_id, words, k, offset, token): one row per window and token."""
    def run(batches):
        for b in batches:
            rows, items = [], b.column("item_id").to_pylist()
            for block in blocks(strings(b.column("text")), alnum=True):
                for i, lo, hi in zip(block.rows, block.lo, block.hi):
                    if lo == hi:
                        continue
                    length = int(min(size, hi - lo))
                    k = min(SHINGLE, length)
                    tokens = signed(RangeHasher(block.h[lo:hi]).every(k)).tolist()
                    plain = block.words(lo, hi)
                    for s in range(len(plain) - length + 1):
                        window = plain[s:s + length]
                        rows += [(items[i], window, k, o, tokens[s + o]) for o in range(length - k + 1)]
            for i in range(0, len(rows), 20_000):
                cols = list(zip(*rows[i:i + 20_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], b.schema.field("item_id").type),
                     pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int64())],
                    ["item_id", "words", "k", "o", "token"])
    src = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["item_id"].dataType.simpleString()
    return src.mapInArrow(freed(run), f"item_id {kind}, words array<string>, k int, o int, token long")


def _token_bits(tokens: DataFrame) -> BitSet:
    return BitSet(bit_set(tokens, ["token"], lambda t: t.view(np.uint64), BITS_LOG2))


def _scan(docs: DataFrame, bits: BitSet, ks: list[int], size: int, counts_only: bool) -> DataFrame:
    """Places of the documents where a token may be in ``bits``: the number
    per token, or each with the words around it plus one row per document
    (token null) with its number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(bits.words)

    def run(batches):
        known = BitSet(shared.value)
        for b in batches:
            d, th = b.column("d").to_numpy(), b.column("th").to_numpy()
            for block in blocks(strings(b.column("text")), alnum=True):
                hasher = RangeHasher(block.h)
                n = block.hi - block.lo
                of = np.repeat(np.arange(len(n)), n)
                tokens, rows = [], []
                for k in ks:
                    g = hasher.every(k)
                    at = np.flatnonzero(known.has(g)) if len(g) else np.empty(0, np.int64)
                    # a token lies within one text
                    at = at[of[at] == of[at + (k - 1)]]
                    if counts_only:
                        tokens.append(g[at])
                        continue
                    for p, i, x in zip(at.tolist(), of[at].tolist(), signed(g[at]).tolist()):
                        lo, hi, row = int(block.lo[i]), int(block.hi[i]), block.rows[i]
                        left = min(p - lo, size - k)
                        rows.append((d[row], th[row], x, hi - lo, p - lo, left,
                                     block.words(p - left, min(hi, p + size))))
                if counts_only:
                    if not tokens:  # no window has a word
                        continue
                    v, c = np.unique(np.concatenate(tokens), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(v)), pa.array(c)], ["token", "n"])
                    continue
                rows += [(d[r], th[r], None, int(m), 0, 0, None) for r, m in zip(block.rows, n)]
                for i in range(0, len(rows), 20_000):
                    c = list(zip(*rows[i:i + 20_000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()),
                         pa.array(c[2], pa.int64()), pa.array(c[3], pa.int64()),
                         pa.array(c[4], pa.int32()), pa.array(c[5], pa.int32()),
                         pa.array(c[6], pa.list_(pa.string()))],
                        ["d", "th", "token", "n_words", "p", "left", "around"])

    src = docs.select("d", "th", "text")
    if counts_only:
        return src.mapInArrow(freed(run), "token long, n long")
    return src.mapInArrow(freed(run), "d long, th long, token long, n_words long, p int, left int, "
                               "around array<string>")


def covered(runs: Column) -> Column:
    """Words covered by an array of (s, e) ranges."""
    step = F.aggregate(
        F.array_sort(runs),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(acc["to"], r["s"]))).alias("n"),
            F.greatest(acc["to"], r["e"]).alias("to")))
    return step["n"]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, size: int = 10,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hits, sizes, windows): hits (d, th, s, e, words) are the exact places
    of benchmark windows, sizes (d, th, n_words) has every document, windows
    is ``item_windows``."""
    src = texts(docs, id_col, text_col)
    wins = cut(item_windows(benchmark, size, item_col, item_text_col))
    ks = [r[0] for r in wins.select("k").distinct().collect()]  # at most SHINGLE values
    uses = (_scan(src, _token_bits(wins), ks, size, True)
            .groupBy("token").agg(F.sum("n").alias("n")))
    rare = (wins.select("words", "k", "o", "token").distinct()
            .join(uses, "token", "left")
            .groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "o", "token", "k"))
                                  .alias("r")))
    prefix = cut(rare.select("words", F.col("r.o").alias("o"), F.col("r.token").alias("want")))
    places = cut(_scan(src, _token_bits(prefix.select(F.col("want").alias("token"))), ks, size, False))
    length = F.size("words")
    hits = (places.filter("token is not null").join(prefix, F.col("token") == F.col("want"))
            # positional bound, then length bound, then the words themselves
            .filter((F.col("p") >= F.col("o")) & (F.col("left") >= F.col("o")))
            .filter(F.col("p") - F.col("o") + length <= F.col("n_words"))
            .filter(F.slice("around", F.col("left") - F.col("o") + 1, length) == F.col("words"))
            .select("d", "th", (F.col("p") - F.col("o")).alias("s"),
                    (F.col("p") - F.col("o") + length).alias("e"), "words"))
    return cut(hits), places.filter("token is null").select("d", "th", "n_words"), wins


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, d, th, n_words, n_hit, n_items, items).

    ``n_hit`` words lie in an occurrence of a benchmark window, ``items`` are
    the sorted ids (as strings) of the items whose windows occur.  Null and
    wordless texts have no words and no hits; items without words or with a
    null id but words count as windows (a null id is listed as nothing).
    Repeated rows and items are fine; other columns are left behind.
    """
    hits, sizes, wins = benchmark_hits(docs, benchmark, size, id_col, text_col, item_col,
                                       item_text_col)
    spans = (hits.groupBy("d", "th").agg(F.collect_set(F.struct("s", "e")).alias("runs"))
             .select("d", "th", covered(F.col("runs")).alias("n_hit")))
    items = (hits.select("d", "th", "words").distinct()
             .join(wins.select("words", F.col("item_id").cast("string").alias("item")).distinct(),
                   "words")
             .groupBy("d", "th").agg(F.sort_array(F.collect_set("item")).alias("items")))
    found = spans.join(items, ["d", "th"], "left")
    found = found.select(F.col("d").alias("hd"), F.col("th").alias("hth"), "n_hit", "items")
    ids = texts(docs, id_col, text_col).select("doc_id", "d", "th")
    per_text = sizes.distinct().select(F.col("d").alias("sd"), F.col("th").alias("sth"), "n_words")
    return (ids.join(per_text, (F.col("d") == F.col("sd")) & (F.col("th") == F.col("sth")))
            .join(found, (F.col("d") == F.col("hd")) & (F.col("th") == F.col("hth")), "left")
            .select("doc_id", "d", "th", "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
