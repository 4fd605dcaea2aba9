"""Substring dedup by seed and extend over winnowed anchors.

Words are hashed and winnowed: of every ``min_words - SEED + 1`` consecutive
SEED-word runs the one with the smallest hash (rightmost on ties) is an
anchor.  Equal runs of ``min_words`` words choose the same anchor wherever
they occur, so documents that share such a run meet at one.

Seed: anchors are grouped; only those of two documents or more are seeds.
Extend: a seed is extended left and right over all the windows that chose it.
Occurrences whose whole extension is equal form a class, and every document of
a class but its first, the head, is covered by the extension: no pairs are
formed.  Only heads that share a seed but differ further out are compared
window by window.  Adjacent covered runs merge into maximal repeats.  A run
counts as repeated if it also occurs in a document with a smaller id.

Bit sets of a fixed size carry seeds and heads back to the document scans, so
that little is shuffled.  They only let rows through: a row that is not among
the heads is surely covered, and whatever passes by chance is settled by the
exact joins.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, slices, strings, texts, written
from .words import BitSet, RangeHasher, bit_set, blocks, mix, signed, space_words

SEED = 5
#: Bits (log2) of the sets that travel back to the scans: seeds and heads, and
#: the smaller ones.  More bits let less through by chance; raise them with the
#: executors' memory (30 are 128 MB).
BITS_LOG2 = 26
FEW_LOG2 = 24
#: Words winnowed at a time.
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def winnow(g: np.ndarray, n: int, w: int) -> np.ndarray:
    """For each of n places, where the smallest of the w seed hashes from
    there lies.  The upper 40 bits order, the rightmost of equal ones wins."""
    place = np.arange(len(g), dtype=np.uint64)
    key = (g & ~_PLACE) | (_PLACE - place)
    low, span = key, 1
    while span < w:
        step = min(span, w - span)
        low = np.minimum(low[:len(low) - step], low[step:])
        span += step
    return (_PLACE - (low[:n] & _PLACE)).astype(np.int64)


def anchors(texts_, min_words: int):
    """Per block of texts (row, anchor, extension, first window, windows,
    hasher, first window in the hasher), many texts at a time."""
    for block in blocks(texts_):
        n = len(block.h)
        # whether a window starts at each word: pieces overlap by a window
        left = np.repeat(block.hi, block.hi - block.lo) - np.arange(n)
        of = np.repeat(np.arange(len(block.rows)), block.hi - block.lo)
        for a in range(0, n, _PIECE):
            h = block.h[a:a + _PIECE + min_words - 1]
            at = np.flatnonzero(left[a:a + _PIECE] >= min_words)
            if not len(at):
                continue
            hasher = RangeHasher(h)
            seeds = hasher.every(SEED)
            low = winnow(seeds, len(h) - min_words + 1, min_words - SEED + 1)[at]
            new = np.flatnonzero(np.diff(low, prepend=-1))
            count = np.diff(new, append=len(low))
            first = at[new]
            # the extension: all words of all windows of the anchor, its place
            c = hasher.of(first, first + count + (min_words - 1))
            c ^= (low[new] - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            text = of[a + first]
            yield (block.rows[text], seeds[low[new]], c, a + first - block.lo[text], count,
                   hasher, first)


def _head_hash(a: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return mix(mix(a ^ mix(c)) + d.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))


def _u(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint64)


def repeated_runs(docs: DataFrame, min_words: int = 13, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(d, th, runs): for each document with repeated runs, the covered word
    ranges ``array<struct<s, e>>``, unmerged; d orders null ids last."""
    if min_words < SEED:
        raise ValueError(f"min_words must be at least {SEED}")
    src = texts(docs, id_col, text_col).drop("doc_id")
    share = docs.sparkSession.sparkContext.broadcast

    # 1. seeds: anchors of two documents (40 bits of the hash: a filter only)
    def seeds(batches):
        for b in batches:
            d = b.column("d").to_numpy()
            for row, a, *_ in anchors(strings(b.column("text")), min_words):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a & np.uint64((1 << 40) - 1))), pa.array(d[row])], ["a", "d"])
    met = (src.select("d", "text").mapInArrow(freed(seeds), "a long, d long")
           .groupBy("a").agg(F.min("d").alias("d0"), F.max("d").alias("d1")).filter("d0 < d1"))
    shared = share(bit_set(met, ["a"], _u, BITS_LOG2))

    # 2. classes of equal extensions, each with its first document (its head)
    def extended(batches):
        seen = BitSet(shared.value)
        for b in batches:
            d = b.column("d").to_numpy()
            for row, a, c, *_ in anchors(strings(b.column("text")), min_words):
                ok = seen.has(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a[ok])), pa.array(signed(c[ok])), pa.array(d[row[ok]])], ["a", "c", "d"])
    first = written(src.select("d", "text").mapInArrow(freed(extended), "a long, c long, d long")
                    .groupBy("a", "c").agg(F.min("d").alias("d0"))
                    .select(F.col("a").alias("ca"), F.col("c").alias("cc"), "d0"), "substring-classes")
    split = share(bit_set(first.groupBy("ca").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"),
                          ["ca"], _u, FEW_LOG2))
    heads = share(bit_set(first, ["ca", "cc", "d0"],
                          lambda a, c, d: _head_hash(_u(a), _u(c), d), BITS_LOG2))

    # 3. what is surely no head is covered whole, runs merged on the spot;
    # possible heads go on, with their windows where a seed has many classes
    kinds = "a long, c long, d long, th long, s int, e int, w array<long>"

    def settle(batches):
        seen, many, is_head = BitSet(shared.value), BitSet(split.value), BitSet(heads.value)
        for b in batches:
            d, th = b.column("d").to_numpy(), b.column("th").to_numpy()
            for row, a, c, s, n, hasher, place in anchors(strings(b.column("text")), min_words):
                ok = np.flatnonzero(seen.has(a))
                if not len(ok):
                    continue
                a, c, row, s, place, n = a[ok], c[ok], row[ok], s[ok], place[ok], n[ok]
                e = s + n + (min_words - 1)
                head = is_head.has(_head_hash(a, c, d[row]))
                r, rs, re_ = row[~head], s[~head], e[~head]
                new = np.flatnonzero(np.concatenate(
                    [[True], (r[1:] != r[:-1]) | (rs[1:] > re_[:-1])])) if len(r) else np.empty(0, np.int64)
                last = np.concatenate([new[1:] - 1, [len(r) - 1]]) if len(r) else new
                k = np.where(head & many.has(a), n, 0)
                at = np.repeat(place - (np.cumsum(k) - k), k) + np.arange(k.sum())
                w = signed(hasher.of(at, at + min_words))
                k = k[head]
                m, h = len(new), int(head.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(signed(a[head]))]),
                     pa.concat_arrays([pa.nulls(m, pa.int64()), pa.array(signed(c[head]))]),
                     pa.array(np.concatenate([d[r[new]], d[row[head]]])),
                     pa.array(np.concatenate([th[r[new]], th[row[head]]])),
                     pa.array(np.concatenate([rs[new], s[head]]).astype(np.int32)),
                     pa.array(np.concatenate([re_[last], e[head]]).astype(np.int32)),
                     pa.ListArray.from_arrays(
                         pa.array(np.concatenate([np.zeros(m + 1), np.cumsum(k)]).astype(np.int32)),
                         pa.array(w))],
                    ["a", "c", "d", "th", "s", "e", "w"])
                assert len(w) == k.sum() and h == len(k)
    found = written(src.mapInArrow(freed(settle), kinds), "substring-seeds")
    sure = found.filter("a is null").select("d", "th", "s", "e")
    maybe = found.filter("a is not null")
    whole = (maybe.select("a", "c", "d", "th", "s", "e")
             .join(first, (F.col("a") == F.col("ca")) & (F.col("c") == F.col("cc")))
             .filter(F.col("d") > F.col("d0")).select("d", "th", "s", "e"))

    # 4. heads that share a seed but differ further out: window by window
    windows = (maybe.filter(F.size("w") > 0)
               .select("a", "d", "th", "s", F.posexplode("w").alias("k", "w"))
               .select("a", "w", "d", "th", (F.col("s") + F.col("k")).alias("s")))
    low = written(windows.groupBy("a", "w").agg(F.min("d").alias("d0"), F.max("d").alias("d1"))
                  .filter("d0 < d1").select(F.col("a").alias("ca"), F.col("w").alias("cw"), "d0"),
                  "substring-windows")
    repeated = share(bit_set(low, ["cw"], _u, FEW_LOG2))

    def likely(batches):
        seen = BitSet(repeated.value)
        for b in batches:
            yield b.filter(pa.array(seen.has(_u(b.column("w").to_numpy()))))
    partly = (windows.mapInArrow(freed(likely), "a long, w long, d long, th long, s int")
              .join(low, (F.col("a") == F.col("ca")) & (F.col("w") == F.col("cw")))
              .filter(F.col("d") > F.col("d0"))
              .select("d", "th", "s", (F.col("s") + min_words).alias("e")))
    # a document's own runs only: bounded by its length
    return written(sure.unionByName(whole).unionByName(partly)
                   .groupBy("d", "th").agg(F.collect_set(F.struct("s", "e")).alias("runs")),
                   "substring-runs")


def merged(runs) -> list[tuple[int, int]]:
    """Maximal repeats: overlapping or touching word ranges joined."""
    out: list[list[int]] = []
    for s, e in sorted((r["s"], r["e"]) for r in runs or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def substring_dedup(docs: DataFrame, min_words: int = 13, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, d, th, n_words, n_removed, spans, kept,
    kept_sha256).

    ``spans`` are the maximal repeated word ranges taken out, ``kept`` the
    other words joined by one space.  Null texts have no words (kept: "").
    Ids decide which occurrence stays: rows of one id never remove from each
    other, null ids come after every id and not before each other.  Texts
    below ``min_words`` words are untouched.  Other columns are left behind.
    """
    runs = repeated_runs(docs, min_words, id_col, text_col)
    src = texts(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def cut_out(b, runs_of):
        cols = {k: [] for k in ("n_words", "n_removed", "spans", "kept", "kept_sha256")}
        for t, r in zip(b.column("text").to_pylist(), runs_of):
            words = space_words(t)
            spans = merged(r)
            at, keep = 0, []
            for s, e in spans:
                keep += words[at:s]
                at = e
            keep += words[at:]
            kept = b" ".join(keep)
            cols["n_words"].append(len(words))
            cols["n_removed"].append(len(words) - len(keep))
            cols["spans"].append([{"s": s, "e": e} for s, e in spans])
            cols["kept"].append(kept.decode("utf-8", "replace"))
            cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("d"), b.column("th"),
             pa.array(cols["n_words"], pa.int64()), pa.array(cols["n_removed"], pa.int64()),
             pa.array(cols["spans"], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
             pa.array(cols["kept"], pa.string()), pa.array(cols["kept_sha256"], pa.string())],
            ["doc_id", "d", "th", *cols])

    def with_runs(batches):
        for b in batches:
            for part in slices(b):
                yield cut_out(part, part.column("runs").to_pylist())

    # only documents that may have runs travel to the join; the set of their
    # text hashes has a fixed size, and the join settles the rest
    touched = docs.sparkSession.sparkContext.broadcast(
        bit_set(runs, ["th"], _u, FEW_LOG2))

    def maybe(batches):
        seen = BitSet(touched.value)
        for b in batches:
            yield b.filter(pa.array(seen.has(_u(b.column("th").to_numpy()))))

    def untouched(batches):
        seen = BitSet(touched.value)
        for b in batches:
            rest = b.filter(pa.array(~seen.has(_u(b.column("th").to_numpy()))))
            for part in slices(rest):
                yield cut_out(part, [None] * part.num_rows)
    out = (f"doc_id {kind}, d long, th long, n_words long, n_removed long, "
           "spans array<struct<s:int,e:int>>, kept string, kept_sha256 string")
    got = runs.select(F.col("d").alias("rd"), F.col("th").alias("rth"), "runs")
    cut_rows = (src.mapInArrow(freed(maybe), f"doc_id {kind}, d long, th long, text string")
                .join(got, (F.col("d") == F.col("rd")) & (F.col("th") == F.col("rth")), "left")
                .select("doc_id", "d", "th", "text", "runs").mapInArrow(freed(with_runs), out))
    return cut_rows.unionByName(src.mapInArrow(freed(untouched), out))
