"""Toxicity by maximum-scoring segments with extreme-value calibration.

Model.  Words are nodes of a trie of prefixes (3-6 characters, then the whole
word).  Over the labelled documents each node counts the toxic and the clean
documents it occurs in.  A node's toxic share has a Dirichlet prior centred on
its parent's share (the root: the share of toxic documents), so inflected or
compounded forms that were never seen inherit from their stem.  A token scores
the log-odds of its deepest significant node against the root.

Scan.  ``token score - DRIFT`` is negative on ordinary text.  A linear-time
scan finds all maximal scoring segments of a document, however long.

Calibration.  Scores of clean text follow Karlin-Altschul statistics: lambda
solves E[exp(lambda s)] = 1 over the clean token scores, and a segment of score
S in n tokens has expectation K n exp(-lambda S).  Every segment's normalised
score max(0, lambda S - ln(K n)) is summed over the document, and a logistic
curve fitted on labelled documents turns the sum into a probability.
"""

from __future__ import annotations

import math
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, sliced, written
from .words import BitSet, alnum_words, bit_set, utf8

PREFIXES = (3, 4, 5, 6)
PRIOR = 2.0
DRIFT = 1.0
#: Log-likelihood ratio against the root below which a node is left out.
SIGNIFICANT = 12.0
#: Bound of the rows that the driver takes for the logistic curve.
CALIBRATION_ROWS = 50_000
LABEL_BITS_LOG2 = 22


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words (all scripts' letters folded)."""
    return alnum_words(text.lower()) if text else []


def nodes(word: bytes) -> list[bytes]:
    """Trie path of a word from the shortest prefix to the word itself; a
    prefix node ends in ``*`` and is cut between characters."""
    if word.isascii():
        n = len(word)
        return [word[:k] + b"*" for k in PREFIXES if n > k] + [word]
    plain = word.decode("utf-8", "replace")
    return [utf8(plain[:k]) + b"*" for k in PREFIXES if len(plain) > k] + [word]


# ------------------------------------------------------------ model
def node_counts(train: DataFrame) -> DataFrame:
    """(node, toxic, clean): labelled documents that hold each node.  Every
    task adds up its own documents before the shuffle."""
    def run(batches):
        # clean documents in the lower half of one number, toxic ones above
        count: dict[bytes, int] = {}
        one = (1, 1 << 32)

        def out():
            v = np.fromiter(count.values(), np.int64, len(count))
            return pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.binary()), pa.array(v & 0xFFFFFFFF), pa.array(v >> 32)],
                ["node", "clean", "toxic"])

        for b in sliced(batches):
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                for node in {n for w in set(tokens(t)) for n in nodes(w)}:
                    count[node] = count.get(node, 0) + one[y]
                if len(count) > 150_000:
                    yield out()
                    count.clear()
        if count:
            yield out()
    return (train.select("text", "y").mapInArrow(freed(run), "node binary, clean long, toxic long")
            .groupBy("node").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


class NodeScores:
    """Scores by node: sorted 64-bit hashes and floats, 16 bytes a node."""

    def __init__(self, hashes: np.ndarray, scores: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], scores[order]

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of these hashes are nodes (their places), and their scores."""
        if not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0)
        i = np.minimum(self.hashes.searchsorted(h), len(self.hashes) - 1)
        at = np.flatnonzero(self.hashes[i] == h)
        return at, self.scores[i[at]]


class WordScores(dict):
    """Scores of words seen, ``room`` at most; new ones are looked up together."""

    def __init__(self, model: ToxicityModel, room: int):
        super().__init__()
        self.model, self.room = model, room

    def of(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.get, words))
        if None in found:
            new = list({w for w, v in zip(words, found) if v is None})
            scores = dict(zip(new, self.model.token_scores(new).tolist()))
            found = [scores[w] if v is None else v for w, v in zip(words, found)]
            if len(self) + len(scores) > self.room:
                self.clear()
            self.update(islice(scores.items(), self.room))
        return np.array(found, np.float64)


class ToxicityModel:
    """Scores of all significant nodes plus the calibration constants."""

    def __init__(self, scores: NodeScores, lam: float = 1.0, log_k: float = 0.0,
                 slope: float = 1.0, bias: float = -3.0):
        self.scores, self.lam, self.log_k, self.slope, self.bias = scores, lam, log_k, slope, bias

    def token_scores(self, words: list[bytes]) -> np.ndarray:
        """Each word's score: its deepest node's, or 0."""
        paths = [nodes(w) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(p) for p in paths])
        h = np.fromiter((xxhash.xxh64_intdigest(n) for p in paths for n in p), np.uint64, len(owner))
        at, scores = self.scores.find(h)
        # paths go downwards: a word's last hit is its deepest node
        owner = owner[at]
        last = np.append(owner[1:] != owner[:-1], True)[:len(owner)]
        out = np.zeros(len(words))
        out[owner[last]] = scores[last]
        return out

    def token_score(self, word: bytes) -> float:
        return float(self.token_scores([word])[0])

    def cached(self, room: int = 100_000) -> WordScores:
        return WordScores(self, room)

    def evidence(self, text: str | None, cache) -> tuple[float, list[tuple[int, int, float]]]:
        """Sum of normalised segment scores, and the segments in words."""
        words = tokens(text)
        if not words:
            return 0.0, []
        s = cache.of(words) - DRIFT
        total, found = 0.0, []
        cost = self.log_k + math.log(len(words))
        for a, b, x in maximal_segments(s):
            bits = self.lam * x - cost
            if bits > 0:
                total += bits
                found.append((a, b, bits))
        return total, found

    def probability(self, total: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, self.bias + self.slope * math.log1p(total)))))


def maximal_segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, in linear
    time.  Only positive scores open candidates; the running total over the
    rest comes from one cumulative sum."""
    up = np.flatnonzero(s > 0)
    if len(up) == 0:
        return []
    total = np.concatenate([[0.0], np.cumsum(s)])
    # candidates: start, end, total before, total after, and the index of the
    # last earlier candidate with a smaller total before it
    cand: list[list] = []
    for i in up.tolist():
        a, b, left, right = i, i + 1, total[i], total[i + 1]
        j = len(cand) - 1
        while True:
            while j >= 0 and cand[j][2] >= left:
                j = cand[j][4]
            if j < 0 or cand[j][3] >= right:
                cand.append([a, b, left, right, j])
                break
            a, left = cand[j][0], cand[j][2]
            del cand[j:]
            j = len(cand) - 1
    return [(a, b, float(right - left)) for a, b, left, right, _ in cand]


def _share_scores(rows, n_toxic: int, n_clean: int) -> dict[bytes, float]:
    # shares of toxic and of clean documents apart: of a common word that no
    # clean document has, one less the toxic share is 0 in floating point
    n = n_toxic + n_clean + 1.0
    root = (n_toxic + 0.5) / n, (n_clean + 0.5) / n
    base = math.log(root[0] / root[1])
    share: dict[bytes, tuple[float, float]] = {}
    by_depth = sorted(rows, key=lambda r: (not r[0].endswith(b"*"), len(r[0]), r[0]))
    for node, toxic, clean in by_depth:
        above = root
        path = nodes(node) if not node.endswith(b"*") else nodes(node[:-1] + b"\xc3\xbf")
        for p in path:
            if p != node and len(p) < len(node) + (not node.endswith(b"*")):
                above = share.get(p, above)
        n = toxic + clean + PRIOR
        share[node] = (toxic + PRIOR * above[0]) / n, (clean + PRIOR * above[1]) / n
    return {k: math.log(a / b) - base for k, (a, b) in share.items()}


def _lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1 (bisection); 1 if clean text
    has no positive token."""
    if not (scores[weights > 0] > 0).any():
        return 1.0
    p = weights / weights.sum()
    lo, hi = 1e-3, 20.0
    for _ in range(80):
        mid = (lo + hi) / 2
        if float((p * np.exp(np.minimum(mid * scores, 500))).sum()) > 1:
            hi = mid
        else:
            lo = mid
    return (lo + hi) / 2


def fit_toxicity(train: DataFrame) -> ToxicityModel:
    """``train`` (text, y 0/1), any number of rows -> model.

    All labelled rows are counted and every significant node enters the model
    (16 bytes each).  The driver takes CALIBRATION_ROWS rows of two numbers,
    chosen by the hash of doc_id (if there is one) and text, for the logistic
    curve.  Without both classes the model knows
    no toxic word and scores everything low.
    """
    spark = train.sparkSession
    # rows are told apart by id and text, so copies of a text are sampled one by one
    key = [F.col(c) for c in ("doc_id",) if c in train.columns]
    train = (train.select("text", F.col("y").cast("int").alias("y"), F.xxhash64(*key, "text").alias("h"))
             .filter("y is not null"))
    n = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel(NodeScores(np.empty(0, np.uint64), np.empty(0)))
    pi = n_toxic / (n_toxic + n_clean)

    def xlogx(obs, exp):
        return F.when(F.col(obs) > 0, F.col(obs) * F.log(F.col(obs) / exp)).otherwise(F.lit(0.0))
    seen = F.col("toxic") + F.col("clean")
    g2 = 2 * (xlogx("toxic", seen * pi) + xlogx("clean", seen * (1 - pi)))
    kept = node_counts(train).filter(g2 >= SIGNIFICANT)

    def scored(pdf):
        import pandas as pd
        rows = zip(map(bytes, pdf["node"]), pdf["toxic"].tolist(), pdf["clean"].tolist())
        score = _share_scores(list(rows), n_toxic, n_clean)
        return pd.DataFrame({"h": np.array([xxhash.xxh64_intdigest(k) for k in score], np.uint64).view(np.int64),
                             "score": list(score.values())})
    # a node's ancestors share its first characters, so tries are scored apart
    root = F.substring(F.col("node").cast("string"), 1, min(PREFIXES))
    pdf = kept.groupBy(root).applyInPandas(scored, "h long, score double").toPandas()
    model = ToxicityModel(NodeScores(pdf["h"].to_numpy(np.int64).view(np.uint64), pdf["score"].to_numpy(float)))

    # clean token scores, rounded to 0.1: a histogram of bounded size
    shared = spark.sparkContext.broadcast(model)

    def score_counts(batches):
        cache = shared.value.cached()
        hist: dict[int, int] = {}
        for b in sliced(batches):
            for t in b.column("text").to_pylist():
                ws = tokens(t)
                if ws:
                    s = cache.of(ws) - DRIFT
                    v, c = np.unique(np.round(s * 10).astype(np.int64), return_counts=True)
                    for x, k in zip(v.tolist(), c.tolist()):
                        hist[x] = hist.get(x, 0) + k
        if hist:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(hist), pa.int64()), pa.array(list(hist.values()), pa.int64())],
                ["s", "n"])
    hist = (train.filter("y = 0").select("text").mapInArrow(freed(score_counts), "s long, n long")
            .groupBy("s").agg(F.sum("n").alias("n")).orderBy("s").collect())
    s = np.array([r["s"] / 10 for r in hist] or [0.0])
    w = np.array([r["n"] for r in hist] or [1], np.float64)
    model.lam = _lambda(s, w)
    # K as for a walk whose positive steps are rare: their share times lambda
    up = float(w[s > 0].sum() / w.sum())
    model.log_k = math.log(max(up * model.lam, 1e-2))

    shared2 = spark.sparkContext.broadcast(model)

    def evidence(batches):
        cache = shared2.value.cached()
        for b in sliced(batches):
            x = [shared2.value.evidence(t, cache)[0] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.float64()), b.column("y"), b.column("h")], ["x", "y", "h"])
    total = n_toxic + n_clean
    share = min(1 << 20, int(1.2 * CALIBRATION_ROWS / total * (1 << 20)) + 1)
    # the row count bounds what is taken even if rows are equal in id and text
    pdf = (train.filter(F.col("h").bitwiseAND(F.lit((1 << 20) - 1)) < share)
           .mapInArrow(freed(evidence), "x double, y int, h long")
           .orderBy(F.xxhash64("h"), "y", "x").limit(CALIBRATION_ROWS).toPandas())
    if pdf["y"].nunique() == 2:
        model.slope, model.bias = _logistic(np.log1p(pdf["x"].to_numpy()), pdf["y"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge-stabilised logistic curve by Newton steps."""
    beta = np.zeros(2)
    xx = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(xx @ beta, -30, 30)))
        g = xx.T @ (y - p) - 1e-2 * beta
        h = (xx * (p * (1 - p))[:, None]).T @ xx + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[1]), float(beta[0])


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, score, predicted, passages).

    ``passages`` are the significant segments ``(s, e, bits)`` in words.
    Null, empty and wordless texts have no passage and the score of clean
    text.  Repeated rows score alike; other columns are left behind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("bits", pa.float64())]))

    def run(batches):
        m = shared.value
        cache = m.cached()
        for b in sliced(batches):
            p, where = [], []
            for t in b.column("text").to_pylist():
                x, segs = m.evidence(t, cache)
                p.append(m.probability(x))
                where.append([{"s": s, "e": e, "bits": v} for s, e, v in segs])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(p, pa.float64()),
                 pa.array([int(v >= 0.5) for v in p], pa.int32()), pa.array(where, span)],
                ["doc_id", "score", "predicted", "passages"])
    return src.mapInArrow(freed(run), f"doc_id {kind}, score double, predicted int, "
                               "passages array<struct<s:int,e:int,bits:double>>")


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             label_col: str = "toxic", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y): documents joined with their label (null labels and
    ids aside; a document with several labels is toxic if one says so).

    Texts without a label mostly stay where they are: a set of label ids of
    fixed size filters them before the join, which settles the rest.  The
    result is written once, since fitting reads it several times."""
    y = (labels.filter(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
         .groupBy(F.col(f"`{id_col}`").alias("lid"))
         .agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("y")))
    known = bit_set(y.select(F.xxhash64(F.col("lid").cast("string")).alias("h")), ["h"],
                    lambda h: h.view(np.uint64), LABEL_BITS_LOG2)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                      F.xxhash64(F.col(f"`{id_col}`").cast("string")).alias("h"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def likely(batches):
        seen = BitSet(shared.value)
        for b in batches:
            ok = seen.has(b.column("h").to_numpy().view(np.uint64))
            yield b.filter(pa.array(ok)).select(["doc_id", "text"])
    rows = src.mapInArrow(freed(likely), f"doc_id {kind}, text string")
    # a sort-merge join at every size: texts are dealt out evenly for the fit
    return written(rows.join(y.hint("merge"), F.col("doc_id") == F.col("lid")).select("doc_id", "text", "y"),
                   "toxicity-labelled")
