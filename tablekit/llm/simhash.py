"""SimHash near-duplicates through a generalised pigeonhole search.

Fingerprints are 64-bit majority sketches of word shingles.  To find the pairs
within ``max_bits`` differing bits:

1. Correlated bits are grouped into ``PARTS`` partitions of 16 bits (greedy,
   on the bit correlations over all distinct fingerprints), so that the
   remaining partitions are as independent, hence as selective, as possible.
2. Every fingerprint gets its own thresholds t_1..t_m with
   sum(t_i + 1) = max_bits + 1 (t_i = -1 skips a partition): by the pigeonhole
   principle a pair within ``max_bits`` has some partition with at most t_i
   differing bits.  A dynamic program over partitions picks the allocation
   with the fewest candidates, counted exactly from a histogram of the
   16-bit partition values (PARTS x 65,536 numbers at any input size).
3. The allocated neighbourhoods are probed against the partition index and
   every candidate is verified on all 64 bits.

A fingerprint whose cheapest allocation still costs more than ``BALL`` rows
(it lies in a crowd of near copies, or the corpus is huge) takes an exact
route of fixed cost instead: it emits the 65 values within one bit of itself.
Two fingerprints share such a value if and only if they differ in at most two
bits, and a value has at most 65 owners, so crowds cost no pairs.  A pair with
one fingerprint outside the crowd is found by that one's probes, since the
index holds all fingerprints.  (For other distances than two the crowd emits
its full radius: max_bits // 2 and the rest, see ``_ball``.)
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, freed, sliced, texts
from .components import connected_components
from .words import utf8

PARTS = 4
WIDTH = 64 // PARTS
#: Rows after which the fixed-cost route is the cheaper one.
BALL = 65
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit majority sketch of the word shingles of one text (0: no word)."""
    words = utf8(text).lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    one = xxhash.xxh64_intdigest
    h = np.fromiter((one(g, seed) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _BLOCK):
        part = h[i:i + _BLOCK].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, d, th, fp): one row per input row, fp as a signed long."""
    def run(batches):
        for b in sliced(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()],
                          np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("d"), b.column("th"), pa.array(fp)],
                ["doc_id", "d", "th", "fp"])
    src = texts(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(freed(run), f"doc_id {kind}, d long, th long, fp long")


# ------------------------------------------------------------ partitions
def correlated_parts(n: int, ones: np.ndarray, both: np.ndarray) -> list[list[int]]:
    """Group the 64 bits into PARTS lists of WIDTH: each starts with the free
    bit of the strongest remaining correlation and takes, one by one, the
    free bit most correlated with its members (ties: lowest bit)."""
    if n < 2:
        return [list(range(i * WIDTH, (i + 1) * WIDTH)) for i in range(PARTS)]
    p = ones / n
    cov = both / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.round(np.abs(cov / np.outer(sd, sd)), 9)
    np.fill_diagonal(corr, 0)
    free, parts = list(range(64)), []
    while free:
        sub = corr[np.ix_(free, free)]
        part = [free[int(sub.max(1).argmax())]]
        free.remove(part[0])
        while len(part) < WIDTH:
            best = free[int(corr[np.ix_(part, free)].sum(0).argmax())]
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def _bit_counts(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, bit counts, co-occurrence counts): every task sums its own rows,
    then 64 short rows per task are added up."""
    def run(batches):
        both = np.zeros((64, 64), np.float64)
        n = 0
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for i in range(0, len(v), _BLOCK):
                x = np.unpackbits(v[i:i + _BLOCK].view(np.uint8), bitorder="little")
                x = x.reshape(-1, 64).astype(np.float32)
                both += x.T @ x
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(64), 64)), pa.array(np.tile(np.arange(64), 64)),
                 pa.array(both.ravel().astype(np.int64)), pa.array(np.full(4096, n))],
                ["i", "j", "k", "n"])
    pdf = (fps.select("fp").mapInArrow(freed(run), "i long, j long, k long, n long")
           .groupBy("i", "j").agg(F.sum("k").alias("k"), F.sum("n").alias("n")).toPandas())
    both = np.zeros((64, 64))
    both[pdf["i"], pdf["j"]] = pdf["k"]
    return int(pdf["n"].iloc[0]) if len(pdf) else 0, np.diag(both).copy(), both


def part_values(fp: np.ndarray, parts: list[list[int]]) -> list[np.ndarray]:
    out = []
    for bits in parts:
        v = np.zeros(len(fp), np.uint64)
        for k, b in enumerate(bits):
            v |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
        out.append(v.astype(np.int64))
    return out


def neighbour_masks(radius: int) -> list[int]:
    """Flips of at most ``radius`` of WIDTH bits, by size."""
    return [sum(1 << b for b in c) for r in range(radius + 1)
            for c in combinations(range(WIDTH), r)]


def candidate_counts(hist: np.ndarray, max_bits: int) -> np.ndarray:
    """[partition, t + 1, value] -> index entries within t bits; t = -1: 0."""
    values = np.arange(1 << WIDTH)
    out = np.zeros((PARTS, max_bits + 2, 1 << WIDTH), np.int64)
    for t in range(max_bits + 1):
        out[:, t + 1] = out[:, t]
        for c in combinations(range(WIDTH), t):
            out[:, t + 1] += hist[:, values ^ sum(1 << b for b in c)]
    # each probed value costs a row as well
    probes = np.cumsum([0] + [len(neighbour_masks(t)) - len(neighbour_masks(t - 1) if t else [])
                              for t in range(max_bits + 1)])
    return out + probes[None, :, None]


def allocate(costs: list[np.ndarray], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Dynamic program: ``costs[i][u]`` is what u = t_i + 1 costs each row in
    partition i; choose u_i with sum u_i = budget.  -> (cost, u per partition)."""
    n = costs[0].shape[1]
    best = np.full((budget + 1, n), np.iinfo(np.int64).max // 4)
    best[0] = 0
    picks = []
    for c in costs:
        new = np.full_like(best, np.iinfo(np.int64).max // 4)
        pick = np.zeros((budget + 1, n), np.int8)
        for spent in range(budget + 1):
            for u in range(spent + 1):
                total = best[spent - u] + c[u]
                less = total < new[spent]
                new[spent] = np.where(less, total, new[spent])
                pick[spent] = np.where(less, u, pick[spent])
        best = new
        picks.append(pick)
    left = np.full(n, budget)
    us = []
    for pick in reversed(picks):
        u = pick[left, np.arange(n)]
        us.append(u)
        left = left - u
    return best[budget], np.array(us[::-1])


def _ball(fp: np.ndarray, radius: int) -> np.ndarray:
    """[row, flip]: all values within ``radius`` bits."""
    masks = np.array([sum(1 << b for b in c) for r in range(radius + 1)
                      for c in combinations(range(64), r)], np.uint64)
    return fp[:, None] ^ masks[None, :]


# ------------------------------------------------------------ links
def linked_fingerprints(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b) that connect exactly the
    fingerprints reachable by steps of at most ``max_bits`` bits."""
    spark = fps.sparkSession
    n, ones, both = _bit_counts(fps)
    parts = correlated_parts(n, ones, both)

    def keys(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            vs = part_values(fp.view(np.uint64), parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([i * (1 << WIDTH) + v for i, v in enumerate(vs)])),
                 pa.array(np.tile(fp, PARTS))], ["key", "fp"])

    index = fps.select("fp").mapInArrow(freed(keys), "key long, fp long")
    # PARTS * 65,536 rows at most, whatever the input
    counted = index.groupBy("key").count().toPandas()
    hist = np.zeros(PARTS << WIDTH, np.int64)
    hist[counted["key"].to_numpy(np.int64)] = counted["count"].to_numpy(np.int64)
    hist = hist.reshape(PARTS, -1)
    costs = spark.sparkContext.broadcast(candidate_counts(hist, max_bits))
    full = spark.sparkContext.broadcast(hist.ravel() > BALL)

    def priced(fp):
        vs = part_values(fp.view(np.uint64), parts)
        cost, us = allocate([costs.value[i][:, v] for i, v in enumerate(vs)], max_bits + 1)
        return vs, us, cost > BALL

    def probes(batches):
        masks = [np.array(neighbour_masks(t), np.int64) for t in range(max_bits + 1)]
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            vs, us, crowd = priced(fp)
            ks, qs = [], []
            for i, v in enumerate(vs):
                for t in range(max_bits + 1):
                    at = np.flatnonzero((us[i] == t + 1) & ~crowd)
                    if len(at):
                        ks.append((i * (1 << WIDTH) + (v[at][:, None] ^ masks[t][None, :])).ravel())
                        qs.append(np.repeat(fp[at], len(masks[t])))
            if ks:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ks)), pa.array(np.concatenate(qs))], ["key", "q"])

    def indexed(batches):
        # a bucket above BALL entries is never probed: any allocation that
        # touches it costs more than the fixed route
        for b in keys(batches):
            yield b.filter(pa.array(~full.value[b.column("key").to_numpy()]))

    near = (fps.select("fp").mapInArrow(freed(probes), "key long, q long")
            .join(fps.select("fp").mapInArrow(freed(indexed), "key long, fp long"), "key")
            .filter((F.col("q") != F.col("fp"))
                    & (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= max_bits))
            .select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b")))

    def balls(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            crowd = fp[priced(fp)[2]]
            for i in range(0, len(crowd), 1024):
                part = crowd[i:i + 1024]
                z = _ball(part.view(np.uint64), (max_bits + 1) // 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(z.ravel().view(np.int64)),
                     pa.array(np.repeat(part, z.shape[1]))], ["z", "fp"])

    owners = (fps.select("fp").mapInArrow(freed(balls), "z long, fp long")
              .groupBy("z").agg(F.collect_set("fp").alias("of")).filter(F.size("of") > 1))
    if max_bits % 2 == 0:
        # owners of one value all lie within max_bits of each other: a star
        crowd = owners.select(F.array_min("of").alias("a"), F.explode("of").alias("b"))
    else:
        # the radii overlap: pairs of the (at most 1 + 64 + ...) owners, verified
        crowd = (owners.select(F.explode("of").alias("a"), "of")
                 .select("a", F.explode("of").alias("b"))
                 .filter((F.col("a") < F.col("b"))
                         & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)))
    return near.unionByName(crowd).filter("a < b").distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, d, th, fp, component_id, keep_d, keep_th).

    ``component_id`` is the smallest doc_id of the documents reachable over
    fingerprints at most ``max_bits`` apart (itself included; null only if no
    member has an id).  (``keep_d``, ``keep_th``) name the group's first
    document by id, null ids last, then by text hash.  Null, empty and
    wordless texts have fingerprint zero and are linked like any other;
    repeated rows stay rows; other columns are left behind.
    """
    thin = cut(fingerprints(docs, shingle, id_col, text_col))
    first = cut(thin.groupBy("fp").agg(F.min("doc_id").alias("low"),
                                       F.min(F.struct("d", "th")).alias("keep")))
    labels = connected_components(linked_fingerprints(first.select("fp"), max_bits))
    rooted = (first.join(labels, F.col("fp") == F.col("node"), "left")
              .select("fp", "low", "keep", F.coalesce("root", "fp").alias("root")))
    groups = cut(rooted.groupBy("root").agg(F.min("low").alias("component_id"),
                                            F.min("keep").alias("keep")))
    by_fp = cut(rooted.select("fp", F.col("root").alias("of"))
                .join(groups, F.col("of") == F.col("root"))
                .select(F.col("fp").alias("key"), "component_id", "keep"))
    return (thin.join(by_fp, F.col("fp") == F.col("key"))
            .select("doc_id", "d", "th", "fp", "component_id",
                    F.col("keep.d").alias("keep_d"), F.col("keep.th").alias("keep_th")))
