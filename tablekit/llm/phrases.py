"""Phrase collocations counted in HAT-tries.

Every task counts the phrases of its texts in one trie a language.  Word ids
lead down a shallow trie (high digit, then the whole id, of the first word,
then of the second) whose leaves are hash containers.  A container that
outgrows ``BURST`` phrases bursts into containers one digit further down.  Once
a task holds ``ROOM`` phrases, the largest subtrees leave whole, each a run
sorted by its words, until half are left.  The runs are a table in the shared
folder; it is dealt out by ranges of (language, phrase), that is by prefixes of
the trie, and each partition merges its runs.  A prefix that holds very many
phrases spans several ranges, so no first word is too common.

A phrase can only occur ``min_count`` times if every pair of neighbours in it
does.  The pass that counts the words therefore also adds up 64-bit hashes of
all neighbours, and the pass that counts phrases skips places whose neighbours
are rare.  A bit set (16 bits a frequent pair, at most ``2**MAX_LOG2``) carries
the frequent hashes to the tasks.  Equal hashes and chance hits only let
phrases be counted in vain; these go with the final count, so all counts are
exact.

Score of a cut of phrase p with a = f(p) into parts with l and r occurrences:
floor(10**6 a a / (l r)) in 38-digit decimals; the lowest-scoring cut counts.

Null texts are empty and null languages are ``und``.  Repeated rows count
again, ties rank by count and then by phrase (UTF-8 order), other columns are
left behind, and an empty table gives no rows.  A long text is counted in
pieces of ``_WINDOW`` bytes that carry the last words on, so its length bounds
nothing but its own string.
"""

from __future__ import annotations

from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, slices, written
from .words import BitSet, bit_set, mix, utf8

#: Phrases in a container before it bursts.
BURST = 4096
#: Phrases, and distinct words and their bytes, that a task holds.
ROOM = 500_000
WORDS = 1 << 18
WORD_BYTES = 1 << 25
#: Largest bit set of frequent pairs (log2 of its bits).
MAX_LOG2 = 30
#: Words counted at a time, bytes of text split at a time, pairs added up at a
#: time, rows and bytes of a record batch.
_FLUSH = 1 << 18
_WINDOW = 1 << 20
_PAIRS = 1 << 21
_ROWS = 20_000
_BYTES = 1 << 25
_ID_BITS = 21
_ID = (1 << _ID_BITS) - 1
#: Where the digits of a packed phrase start, from the root down.
_DIGITS = (51, 42, 30, 21)
_MUL = np.uint64(0xD6E8FEB86659FD93)

#: A-Z folded, the marks that end a piece made one byte that UTF-8 never has,
#: tab made a space.
_FOLD = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9
              else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_END = b"\xff"


class _Node(dict):
    """Digit -> node or container; containers are Counters."""


class HatTrie:
    """Counts of phrases of up to three word ids, packed into one integer with
    the first word in the highest bits; 0 stands for no word."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.root: _Node | Counter = Counter()
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        """Add phrases, in ascending order."""
        self.root = self._add(self.root, 0, keys)

    def _add(self, node, depth, keys):
        if isinstance(node, _Node):
            digit = keys >> _DIGITS[depth]
            edge = np.concatenate([[0], np.flatnonzero(np.diff(digit)) + 1, [len(keys)]]).tolist()
            for d, a, b in zip(digit[edge[:-1]].tolist(), edge, edge[1:]):
                below = node.get(d)
                node[d] = self._add(Counter() if below is None else below, depth + 1, keys[a:b])
            return node
        before = len(node)
        node.update(keys.tolist())
        self.held += len(node) - before
        if len(node) > self.burst and depth < len(_DIGITS):
            below = _Node()
            for k, n in node.items():
                part = below.get(k >> _DIGITS[depth])
                if part is None:
                    part = below[k >> _DIGITS[depth]] = Counter()
                part[k] = n
            return below
        return node

    def spill(self, down_to: int):
        """Whole subtrees of a first word, or of a range of them while that is
        one container, largest first, until at most ``down_to`` phrases are
        held: (keys, counts)."""
        top = _Node(all=self.root) if isinstance(self.root, Counter) else self.root
        units = []
        for d, child in top.items():
            within = child.items() if isinstance(child, _Node) else [(d, child)]
            home = child if isinstance(child, _Node) else top
            units += [(sum(map(len, _containers(x))), home, k) for k, x in within]
        units.sort(key=lambda u: -u[0])
        for size, home, k in units:
            if self.held <= down_to:
                break
            parts = list(_containers(home.pop(k)))
            yield (np.fromiter(chain.from_iterable(parts), np.int64, size),
                   np.fromiter(chain.from_iterable(p.values() for p in parts), np.int64, size))
            self.held -= size
        if isinstance(self.root, Counter) and not top:
            self.root = Counter()


def _containers(node):
    if isinstance(node, _Node):
        for child in node.values():
            yield from _containers(child)
    else:
        yield node


class _Ids(dict):
    """Word -> id from 1; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})
        self.words, self.hashes, self.bytes = [_END], array("Q", [0]), 0

    def __missing__(self, word):
        self[word] = n = len(self.words)
        self.words.append(word)
        return n

    def hashed(self) -> None:
        """Bring hashes and bytes up to the words."""
        new = self.words[len(self.hashes):]
        self.hashes.extend(map(xxhash.xxh64_intdigest, new))
        self.bytes += sum(map(len, new))


def _windows(text: str):
    """Word lists of a text, about ``_WINDOW`` bytes each, with ``_END``
    between pieces; the last ends with it."""
    raw = utf8(text).translate(_FOLD)
    at = 0
    while at < len(raw):
        stop = at + _WINDOW
        if stop < len(raw):
            cuts = [c for c in (raw.rfind(b" ", at, stop), raw.rfind(_END, at, stop)) if c >= 0]
            if not cuts:
                cuts = [c for c in (raw.find(b" ", stop), raw.find(_END, stop)) if c >= 0]
                stop = min(cuts, default=len(raw))
            else:
                stop = max(cuts)
            stop = max(stop, at + 1)
        yield raw[at:stop].replace(_END, b" \xff ").split()
        at = stop
    yield [_END]


def _salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(utf8(lang)))


def _pairs(h: np.ndarray) -> np.ndarray:
    """Hashes of neighbours in an array of word hashes."""
    return mix(mix(h[:-1]) * _MUL + h[1:])


class _Task:
    """What a task holds: a trie a language and the words that they share."""

    def __init__(self, room: int):
        self.room = room
        self.new()

    def new(self) -> None:
        self.ids, self.tries = _Ids(), {}

    def hashes(self, lang: str, x: np.ndarray) -> np.ndarray:
        self.ids.hashed()
        return np.frombuffer(self.ids.hashes, np.uint64)[x] ^ _salt(lang)

    def trie(self, lang: str) -> HatTrie:
        if lang not in self.tries:
            self.tries[lang] = HatTrie()
        return self.tries[lang]

    def spill(self, down_to: int = 0):
        """Sorted runs as record batches (lang, phrase, n)."""
        held = sum(t.held for t in self.tries.values())
        for lang, trie in self.tries.items():
            parts = list(trie.spill(down_to * trie.held // held if held else 0))
            if parts:
                yield from self._rows(lang, *map(np.concatenate, zip(*parts)))

    def _rows(self, lang, keys, counts):
        ids = np.stack([keys >> 2 * _ID_BITS, keys >> _ID_BITS & _ID, keys & _ID])
        rank = np.zeros(len(self.ids.words), np.int64)
        rank[ids] = 1
        rank[0] = 0
        used = np.flatnonzero(rank)
        words = [self.ids.words[i] for i in used.tolist()]
        order = pc.array_sort_indices(pa.array(words, pa.binary())).to_numpy()
        rank[used[order]] = np.arange(1, len(used) + 1)
        ids = rank[ids]
        at = np.argsort(ids[0] << 2 * _ID_BITS | ids[1] << _ID_BITS | ids[2])
        ids, counts = ids[:, at], counts[at]
        words = [None, *(words[i] for i in order.tolist())]
        size = np.array([0, *map(len, words[1:])])[ids].sum(axis=0)
        words = pa.array(words, pa.binary())
        part = np.cumsum(size) // _BYTES * len(at) + np.arange(len(at)) // _ROWS
        edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(at)]]).tolist()
        for a, b in zip(edge, edge[1:]):
            phrase = pc.binary_join_element_wise(
                *(words.take(pa.array(i[a:b])) for i in ids), pa.scalar(b" ", pa.binary()), null_handling="skip")
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (b - a), pa.string()), phrase.cast(pa.string()), pa.array(counts[a:b])],
                ["lang", "phrase", "n"])

    def run(self, batches, tail: int):
        """Feed ``count(lang, ids)`` (a generator of record batches) with the
        ids of all texts; ``tail`` ids at the end of a part start the next."""
        for batch in batches:
            for b in slices(batch, 256):
                waiting: dict[str, array] = {}
                for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                    for words in _windows(text):
                        ids = waiting.setdefault(lang, array("q"))
                        ids.extend(map(self.ids.__getitem__, words))
                        self.ids.hashed()
                        if len(ids) >= _FLUSH:
                            yield from self.count(lang, np.array(ids, np.int64))
                            waiting[lang] = ids[len(ids) - tail:]
                        if len(self.ids) > WORDS or self.ids.bytes > WORD_BYTES:
                            for a, x in waiting.items():
                                yield from self.count(a, np.array(x, np.int64))
                            yield from self.spill()
                            tails = {a: [self.ids.words[i] for i in x[max(0, len(x) - tail):]]
                                     for a, x in waiting.items()}
                            self.new()
                            waiting = {a: array("q", map(self.ids.__getitem__, x)) for a, x in tails.items()}
                for lang, ids in waiting.items():
                    yield from self.count(lang, np.array(ids, np.int64))
        yield from self.spill()

    def full(self):
        if sum(t.held for t in self.tries.values()) > self.room:
            yield from self.spill(self.room // 2)


class _Words(_Task):
    """First pass: words, and hashes of neighbours."""

    def __init__(self, room: int):
        super().__init__(room)
        self.hashed, self.size = [], 0

    def count(self, lang, x):
        # a tail starts the next part; its words are counted there
        self.trie(lang).add(np.sort(x[:-1][x[:-1] > 0] << 2 * _ID_BITS))
        h = _pairs(self.hashes(lang, x))[(x[:-1] > 0) & (x[1:] > 0)]
        self.hashed.append(h)
        self.size += len(h)
        if self.size > _PAIRS:
            yield from self.pairs()
        yield from self.full()

    def pairs(self):
        h, n = np.unique(np.concatenate(self.hashed), return_counts=True)
        self.hashed, self.size = [], 0
        for a in range(0, len(h), 10 * _ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(h[a:a + 10 * _ROWS].view(np.int64)),
                                              pa.array(n[a:a + 10 * _ROWS])], ["h", "n"])


class _Phrases(_Task):
    """Second pass: phrases of two and three words with frequent neighbours."""

    def __init__(self, room: int, frequent: BitSet, max_words: int):
        super().__init__(room)
        self.frequent, self.max_words = frequent, max_words

    def count(self, lang, x):
        if len(x) < 2:
            return
        ok = (x[:-1] > 0) & (x[1:] > 0)
        ok[ok] = self.frequent.has(_pairs(self.hashes(lang, x))[ok])
        two = x[:-1] << 2 * _ID_BITS | x[1:] << _ID_BITS
        # the pair that starts a tail of two words is counted in the next part
        found = [two[:len(two) - self.max_words + 2][ok[:len(two) - self.max_words + 2]]]
        if self.max_words == 3:
            both = ok[:-1] & ok[1:]
            found.append((two[:-1] | x[2:])[both])
        keys = np.sort(np.concatenate(found))
        if len(keys):
            self.trie(lang).add(keys)
        yield from self.full()


def _first_pass(room: int):
    """Task: (lang, text) -> words (lang, phrase, n, null) and hashes of
    neighbours (null, null, n, h)."""
    def run(batches):
        task = _Words(room)
        for out in (task.run(batches, 1), _later(lambda: task.pairs() if task.size else ())):
            for b in out:
                if "h" in b.schema.names:
                    none = pa.nulls(b.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([none, none, b.column("n"), b.column("h")],
                                                     ["lang", "phrase", "n", "h"])
                else:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.int64())],
                                                     ["lang", "phrase", "n", "h"])
    return run


def _later(make):
    yield from make()


def _second_pass(room: int, shared, max_words: int):
    def run(batches):
        yield from _Phrases(room, BitSet(shared.value), max_words).run(batches, max_words - 1)
    return run


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text",
                  lang_col: str = "lang", room: int = ROOM) -> list[DataFrame]:
    """Exact (lang, phrase, f) by number of words: all single words, and the
    phrases of two and three words that occur ``min_count`` times or more."""
    if max_words not in (2, 3):
        raise ValueError("phrases have two or three words")
    src = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    first = written(src.mapInArrow(freed(_first_pass(room)), "lang string, phrase string, n long, h long")
                    .groupBy("lang", "phrase", "h").agg(F.sum("n").alias("f"))
                    .filter((F.col("f") >= min_count) | F.col("phrase").isNotNull()), "phrases-words")
    frequent = first.filter("phrase is null").select("h")
    need = max(16 * frequent.count(), 1 << 16)
    shared = docs.sparkSession.sparkContext.broadcast(
        bit_set(frequent, ["h"], lambda h: h.view(np.uint64), min(MAX_LOG2, (need - 1).bit_length())))
    runs = written(src.mapInArrow(freed(_second_pass(room, shared, max_words)), "lang string, phrase string, n long"),
                   "phrases-runs")
    longer = written(runs.repartitionByRange("lang", "phrase").groupBy("lang", "phrase")
                     .agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
                     .withColumn("size", F.size(F.split("phrase", " "))), "phrases-counts")
    return [first.filter("phrase is not null").select("lang", "phrase", "f"),
            *(longer.filter(F.col("size") == k).select("lang", "phrase", "f") for k in range(2, max_words + 1))]


def _score(a, left, right):
    big = "decimal(14,0)"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as {big}) * cast({a} as {big}))"
                  f" div (cast({left} as {big}) * cast({right} as {big}))")


def _part(words: str, at: int, n: int):
    return F.array_join(F.slice(words, at, n), " ")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang", room: int = ROOM) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases a language."""
    counts = phrase_counts(docs, max_words, min_count, text_col, lang_col, room)
    total = counts[0].groupBy("lang").agg(F.sum("f").alias("n"))
    scored = []
    for size in range(2, max_words + 1):
        c = counts[size - 1].withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))
        for k in range(1, size):
            for side, at, n in (("l", 1, k), ("r", k + 1, size - k)):
                part = counts[n - 1].filter(F.col("f") >= min_count).select(
                    F.col("lang").alias("pl"), F.col("phrase").alias("pp"), F.col("f").alias(f"{side}{k}"))
                c = (c.withColumn("part", _part("words", at, n))
                     .join(part, (F.col("lang") == F.col("pl")) & (F.col("part") == F.col("pp")))
                     .drop("pl", "pp", "part"))
        cuts = F.array_sort(F.array(*[
            F.struct(_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"),
                     F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]))
        scored.append(c.withColumn("cut", cuts[0]).select("lang", "phrase", "words", "a", "cut.score",
                                                          "cut.l", "cut.r"))
    kept = []
    for size, c in enumerate(scored, 2):
        longer = [counts[m - 1].select("lang", "f", F.explode(F.array(*[
            F.array_join(F.slice(F.split("phrase", " "), i, size), " ") for i in range(1, m - size + 2)]))
            .alias("phrase")) for m in range(size + 1, max_words + 1)]
        if longer:
            held = longer[0]
            for x in longer[1:]:
                held = held.unionByName(x)
            held = held.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
            c = (c.join(held, ["lang", "phrase"], "left")
                 .filter("longest is null or 2 * longest < a").drop("longest"))
        kept.append(c.drop("words"))
    rows = kept[0]
    for c in kept[1:]:
        rows = rows.unionByName(c)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of 64 parts of a language first, so that no task sorts it whole
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    rows = (rows.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("part", "rank"))
    best = Window.partitionBy("lang").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return (rows.join(total, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))
