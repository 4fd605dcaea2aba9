"""Language ID by interpolated Kneser-Ney character models.

Texts are reduced to lower-cased letters and single spaces.  A model of order
ORDER per language holds, for every order, a sorted array of packed n-grams
(16 bits a character, so the hash of an n-gram is the n-gram) next to its
counts: raw counts at the top order, counts of distinct left contexts below.
All training text is counted (summed per task, then shuffled), and every
counted n-gram of every language enters the broadcast model, so its size grows
with the number of distinct n-grams.

A text's cross-entropy per character under every language decides; the score
is the softmax posterior over languages, scaled on held-in text, times a tail
probability of the winner's cross-entropy among its own language's texts, and
texts below the calibrated quantile are rejected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, freed, sliced

ORDER = 4
CALIBRATION_ROWS = 4_000
REJECT_QUANTILE = 0.005
UNKNOWN = "und"
_BATCH = 4_000_000
_TABLE: np.ndarray | None = None
_U16 = np.uint64(16)


def _letters() -> np.ndarray:
    """Code unit -> lower-cased letter, or a space for anything else."""
    global _TABLE
    if _TABLE is None:
        t = np.full(1 << 16, 32, np.uint16)
        for i in range(1 << 16):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else i
        _TABLE = t
    return _TABLE


def units(text: str | None) -> np.ndarray:
    """The letters of a text with single spaces between words and around.
    Characters beyond the basic plane count as letters if they are; they are
    folded to 16 bits.  Empty if there is no letter."""
    if not text:
        return np.empty(0, np.uint16)
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    high = cp > 0xFFFF
    u = _letters()[np.where(high, 32, cp)]
    if high.any():
        at = np.flatnonzero(high)
        alpha = np.array([chr(c).isalpha() for c in cp[at]])
        u = u.copy()
        u[at[alpha]] = (0xE000 + cp[at[alpha]] % 0x1900).astype(np.uint16)
    space = u == 32
    if space.all():
        return np.empty(0, np.uint16)
    keep = ~(space & np.concatenate([[True], space[:-1]]))
    body = u[keep]
    if body[-1] == 32:
        body = body[:-1]
    return np.concatenate([[32], body, [32]]).astype(np.uint16)


def ngrams(u: np.ndarray, n: int = ORDER) -> np.ndarray:
    """Packed n-grams; the text is padded left with spaces so that every
    character but the first space is predicted once."""
    if len(u) < 2:
        return np.empty(0, np.uint64)
    x = np.concatenate([np.full(n - 2, 32, np.uint16), u]).astype(np.uint64)
    m = len(x) - n + 1
    out = x[:m].copy()
    for j in range(1, n):
        out = (out << _U16) | x[j:j + m]
    return out


def _runs(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with summed weights."""
    if len(keys) == 0:
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first)


def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 0:
        return np.zeros(len(q), np.int64), np.zeros(len(q), bool)
    i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    return i, keys[i] == q


class CharModel:
    """One language: sorted n-gram arrays and interpolated Kneser-Ney."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        keys, counts = _runs(keys.astype(np.uint64), counts.astype(np.float64))
        self.levels = []
        for n in range(ORDER, 0, -1):
            n1, n2 = float((counts == 1).sum()), float((counts == 2).sum())
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            ctx, total = _runs(keys >> _U16, counts)
            _, kinds = _runs(keys >> _U16, np.ones(len(keys)))
            self.levels.append((n, keys, counts, d, ctx, total, kinds))
            # continuation counts: distinct left contexts of the shorter n-gram
            mask = np.uint64((1 << 16 * (n - 1)) - 1) if n > 1 else np.uint64(0)
            if n > 1:
                keys, counts = _runs(keys & mask, np.ones(len(keys)))
        self.symbols = max(1, len(self.levels[-1][1]))

    def logp(self, q: np.ndarray) -> np.ndarray:
        """Natural log of p(last character | the characters before it)."""
        p = np.full(len(q), 1.0 / (self.symbols + 1))
        for n, keys, counts, d, ctx, total, kinds in reversed(self.levels):
            g = q & np.uint64((1 << 16 * n) - 1)
            i, hit = _find(keys, g)
            j, known = _find(ctx, g >> _U16)
            if len(keys) == 0:
                continue
            c = np.where(hit, counts[i], 0.0)
            t = np.where(known, total[j], 1.0)
            lam = np.where(known, d * kinds[j] / t, 1.0)
            p = np.where(known, np.maximum(c - d, 0) / t, 0.0) + lam * p
        return np.log(p)


class LanguageModels:
    """All languages' models and the calibration constants."""

    def __init__(self, models: dict[str, CharModel]):
        self.langs = sorted(models)
        self.models = [models[x] for x in self.langs]
        self.scale = 40.0
        self.mean = np.zeros(len(self.langs))
        self.sd = np.ones(len(self.langs))
        self.reject_below = 0.0

    def cross_entropy(self, grams: list[np.ndarray]) -> np.ndarray:
        """[text, language]: nats per character; texts are not empty."""
        n = np.array([len(g) for g in grams])
        # each distinct n-gram is looked up once a language
        back, q = pd.factorize(np.concatenate(grams))
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        out = np.empty((len(grams), len(self.models)))
        for k, m in enumerate(self.models):
            out[:, k] = -np.add.reduceat(m.logp(q)[back], starts) / n
        return out

    def judge(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score) per text."""
        best = h.argmin(1)
        e = np.exp(-self.scale * (h - h.min(1, keepdims=True)))
        post = e.max(1) / e.sum(1)
        z = (h[np.arange(len(h)), best] - self.mean[best]) / self.sd[best]
        tail = 1 / (1 + np.exp(np.clip(2 * (z - 6), -50, 50)))
        return best, np.clip(post * tail, 0, 1)

    def score_texts(self, rows: list[str | None]):
        """(lang or None, score) per text; None without a letter."""
        lang: list[str | None] = [None] * len(rows)
        score = np.zeros(len(rows))
        if not self.langs:
            return lang, score
        at, grams, size = [], [], 0

        def flush():
            best, s = self.judge(self.cross_entropy(grams))
            for k, b, v in zip(at, best, s):
                lang[k], score[k] = self.langs[b], v
        for k, t in enumerate(rows):
            g = ngrams(units(t))
            if len(g):
                at.append(k)
                grams.append(g)
                size += len(g)
            if size > _BATCH:
                flush()
                at, grams, size = [], [], 0
        if at:
            flush()
        return lang, score


def ngram_counts(train: DataFrame) -> DataFrame:
    """(lang, g, n) over all rows of ``train`` (text, lang)."""
    def run(batches):
        for b in batches:
            rows: dict[str, list[np.ndarray]] = {}
            size = 0

            def out():
                for lang, gs in rows.items():
                    v, n = np.unique(np.concatenate(gs), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(v), pa.string()), pa.array(v.view(np.int64)), pa.array(n)],
                        ["lang", "g", "n"])
            for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                g = ngrams(units(t))
                if len(g):
                    rows.setdefault(lang, []).append(g)
                    size += len(g)
                if size > _BATCH:
                    yield from out()
                    rows, size = {}, 0
            yield from out()
    return (train.select("lang", "text").mapInArrow(freed(run), "lang string, g long, n long")
            .groupBy("lang", "g").agg(F.sum("n").alias("n")))


def fit_languages(train: DataFrame) -> LanguageModels:
    """``train`` (text, lang), null langs ignored -> models.  Every row is
    counted and every n-gram kept; CALIBRATION_ROWS rows (smallest hashes of
    doc_id, if there is one, and text) set the posterior's scale and the
    rejection bound."""
    key = [F.col(c) for c in ("doc_id",) if c in train.columns]
    train = (train.select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64(*key, "text").alias("h"))
             .filter("lang is not null"))
    counts = cut(ngram_counts(train))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    at = train.sparkSession.createDataFrame(list(enumerate(langs)), "at int, name string")
    got = counts.join(F.broadcast(at), F.col("lang") == F.col("name")).select("at", "g", "n").toArrow()
    of, g, n = (got.column(c).to_numpy() for c in ("at", "g", "n"))
    del got
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=len(langs)))
    models = {}
    for lang, rows in zip(langs, np.split(order, ends[:-1]) if langs else []):
        models[lang] = CharModel(g[rows].view(np.uint64), n[rows])
    lm = LanguageModels(models)
    if langs:
        _calibrate(lm, train)
    return lm


def _calibrate(lm: LanguageModels, train: DataFrame) -> None:
    total = train.count()
    share = min(1 << 20, int(1.2 * CALIBRATION_ROWS / max(1, total) * (1 << 20)) + 1)
    shared = train.sparkSession.sparkContext.broadcast(lm)

    def run(batches):
        m = shared.value
        for b in sliced(batches):
            lang, hs, key = [], [], []
            for y, t, k in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), b.column("h").to_pylist()):
                g = ngrams(units(t))
                if len(g):
                    lang.append(y)
                    hs.append(m.cross_entropy([g])[0].tolist())
                    key.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(hs, pa.list_(pa.float64())), pa.array(key, pa.int64())],
                ["lang", "h", "key"])
    # the row count bounds what is taken even if rows are equal in id and text
    rows = (train.filter(F.col("h").bitwiseAND(F.lit((1 << 20) - 1)) < share)
            .mapInArrow(freed(run), "lang string, h array<double>, key long")
            .orderBy(F.xxhash64("key"), "lang").limit(CALIBRATION_ROWS).collect())
    if not rows:
        return
    hs = np.array([r["h"] for r in rows])
    place = {x: i for i, x in enumerate(lm.langs)}
    y = np.array([place[r["lang"]] for r in rows])
    # the posterior's scale with the best likelihood of the given languages
    gap = hs - hs.min(1, keepdims=True)
    best = None
    for scale in (2.5, 5.0, 10.0, 20.0, 40.0, 80.0):
        e = np.exp(-scale * gap)
        nll = -np.log(np.maximum(e[np.arange(len(y)), y] / e.sum(1), 1e-12)).mean()
        if best is None or nll < best:
            best, lm.scale = nll, scale
    for k in range(len(lm.langs)):
        own = hs[y == k, k]
        if len(own) >= 5:
            mid = float(np.median(own))
            lm.mean[k] = mid
            lm.sd[k] = max(1e-3, 1.4826 * float(np.median(np.abs(own - mid))))
    lm.reject_below = float(np.quantile(lm.judge(hs)[1], REJECT_QUANTILE))


def identify_language(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, lang, best, score, accepted).

    ``best`` is the language with the lowest cross-entropy per character,
    ``und`` for null texts and texts without a letter (score 0); ``lang`` is
    ``best`` or, where the score is below the calibrated bound, ``und``.
    Repeated rows score alike; other columns are left behind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in sliced(batches):
            lang, score = m.score_texts(b.column("text").to_pylist())
            best = [x or UNKNOWN for x in lang]
            ok = [x is not None and v >= m.reject_below for x, v in zip(lang, score)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x if y else UNKNOWN for x, y in zip(best, ok)]),
                 pa.array(best), pa.array(score), pa.array(ok)],
                ["doc_id", "lang", "best", "score", "accepted"])
    return src.mapInArrow(freed(run), f"doc_id {kind}, lang string, best string, score double, "
                               "accepted boolean")
