"""SentencePiece (BPE) encoding and decoding by a max-plus parallel scan.

Merging is recast as a best-path problem.  A sequence of pieces is the BPE
encoding of its text if and only if every piece encodes to itself and every
two neighbours, encoded together, come out as those two pieces: merges are
ordered by (score, leftmost), so a first merge over a boundary would already
happen in the two neighbours alone.  In max-plus terms a step between
compatible pieces weighs 0 and any other minus infinity; the one path of
weight 0 is the encoding.  Results equal the library's, id for id.

Giant documents are split into chunks.  The state at a cut is the piece that
crosses or ends at it (how far it reaches over, and which piece).  A chunk's
transfer matrix holds, for every exit state, the entry states it can be
reached from (rows of 0 / minus infinity, kept as bit masks).  Matrices are
composed associatively along the document, the entry vector of every chunk
follows, a backward pass fixes each chunk's entry and exit state, and every
chunk is then traced back on its own, in parallel.

A cut before a word start has a single state (no piece reaches over it), so
its matrix is one number: cuts are made there whenever a chunk has one, and
whole words between them are encoded once per worker and remembered.  Only
runs longer than a chunk without any word start are cut in mid-run.
"""

from __future__ import annotations

import json
import re
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, slices, texts

SPACE = "▁"
#: Code points after which a document is giant, and of one chunk of it.
CHUNK = 32_768
_LONG_WORD = 48
#: Ids decoded at a time; words that a worker remembers, twice at most.
_GATHER = 200_000
_ROOM = 100_000

State = tuple[int, str]


class Pieces:
    """Vocabulary of a BPE model with byte fallback; its size has a bound."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[bool],
                 byte_ids: dict[int, int], unk_id: int):
        self.pieces = pieces
        self.ids = {p: i for i, p in enumerate(pieces) if normal[i]}
        self.rank = {p: -scores[i] for p, i in self.ids.items()}
        self.byte_ids, self.unk_id = byte_ids, unk_id
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("pieces that reach over word starts are not supported")
        inside = set().union(*self.ids) if self.ids else set()
        #: characters of no piece stand alone: safe cuts on both sides
        self.alone = "".join(c for c in "\n\t\r" if c not in inside)
        a = re.escape(self.alone)
        self.word = re.compile(f"{SPACE}+[^{SPACE}{a}]*|[^{SPACE}{a}]+" + (f"|[{a}]" if a else ""))
        self._pair: dict[tuple[str, str], bool] = {}
        self._self: dict[str, bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._pool = None

    def __getstate__(self):
        return self.__dict__ | {"_pair": {}, "_self": {}, "_words": {}, "_older": {}, "_pool": None}

    @staticmethod
    def load(model_file: str) -> "Pieces":
        """Read the vocabulary of a ``.model`` file (nothing else of the
        library is used).  Models that change text beyond the space marker
        are refused."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if sp.normalize(" ﬁ  x ") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("only models with the identity normaliser and a space prefix")
        n = len(sp)
        byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        normal = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
                  for i in range(n)]
        return Pieces([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)],
                      normal, byte_ids, sp.unk_id())

    # -------------------------------------------------- short strings
    def merge(self, s: str) -> list[str]:
        """Merge neighbours, best score first, leftmost on ties."""
        parts, rank, none = list(s), self.rank.get, float("inf")
        left = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while left:
            best = min(left)
            if best == none:
                break
            i = left.index(best)
            parts[i] += parts.pop(i + 1)
            left.pop(i)
            if i < len(left):
                left[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                left[i - 1] = rank(parts[i - 1] + parts[i], none)
        return parts

    def stands(self, u: str) -> bool:
        ok = self._self.get(u)
        if ok is None:
            ok = self._self[u] = (len(u) == 1 or u in self.ids) and self.merge(u) == [u]
        return ok

    def joins(self, t: str | None, u: str) -> bool:
        """Weight 0 (True) or minus infinity of the step from t to u."""
        if t is None:
            return self.stands(u)
        ok = self._pair.get((t, u))
        if ok is None:
            if len(self._pair) > 2_000_000:
                self._pair.clear()
            ok = self._pair[t, u] = self.stands(t) and self.stands(u) and self.merge(t + u) == [t, u]
        return ok

    def piece_ids(self, u: str) -> list[int]:
        i = self.ids.get(u)
        if i is not None:
            return [i]
        if self.byte_ids:
            return [self.byte_ids[b] for b in u.encode("utf-8", "surrogatepass")]
        return [self.unk_id]

    def word_ids(self, w: str) -> tuple[int, ...]:
        got = self._words.get(w)
        if got is not None:
            return got
        if len(self._words) >= _ROOM:
            # words in use move over from the older half, the others go
            self._older, self._words = self._words, {}
        got = self._older.get(w)
        if got is None:
            parts = self.merge(w) if len(w) <= _LONG_WORD else self.trace(w)
            got = tuple(chain.from_iterable(map(self.piece_ids, parts)))
        if len(w) <= 4 * _LONG_WORD:
            self._words[w] = got
        return got

    # -------------------------------------------------- lattice
    def ending(self, s: str, p: int, low: int):
        """Pieces of s that end at p and start at low or later."""
        for n in range(1, min(self.longest, p - low) + 1):
            u = s[p - n:p]
            if n == 1 or u in self.ids:
                yield u

    def lattice(self, s: str, b0: int, b1: int, entry: list[State] | None, closed_right: bool):
        """Reachability masks over ``s[b0:b1]``: [position] -> {piece: mask of
        entry states}.  entry None: the run starts at b0."""
        nodes: dict[int, dict[str | None, int]] = {}
        if entry is None:
            nodes[b0] = {None: 1}
        else:
            for i, (e, u) in enumerate(entry):
                nodes.setdefault(b0 + e, {})[u] = 1 << i
        end = b1 if closed_right else min(len(s), b1 + self.longest - 1)
        for p in range(b0 + 1, end + 1):
            here = nodes.get(p, {})
            for u in self.ending(s, p, b0):
                q = p - len(u)
                if q >= b1:
                    continue
                mask = 0
                for t, m in nodes.get(q, {}).items():
                    if self.joins(t, u):
                        mask |= m
                if mask:
                    here[u] = here.get(u, 0) | mask
            if here:
                nodes[p] = here
        return nodes

    def entry_states(self, s: str, b0: int) -> list[State]:
        """All pieces that cross or end at b0."""
        out = []
        for p in range(b0, min(len(s), b0 + self.longest - 1) + 1):
            out += [(p - b0, u) for u in self.ending(s, p, 0) if p - len(u) < b0]
        return out

    def backtrace(self, s: str, b0: int, start: State | None, end: int, last: str) -> list[str]:
        """The pieces after ``start`` up to the one ``last`` that ends at
        ``end``; only nodes reachable from ``start`` are kept."""
        nodes = self.lattice(s, b0, end, None if start is None else [start], True)
        first = b0 if start is None else b0 + start[0]
        u, p, out = last, end, []
        while p > first:
            out.append(u)
            p -= len(u)
            if p == first:
                break
            u = next(t for t in nodes[p] if p - len(t) >= first and self.joins(t, u))
        return out[::-1]

    def trace(self, s: str) -> list[str]:
        """Best path over a whole run, one state per position."""
        last: list[str | None] = [None] * (len(s) + 1)
        for p in range(1, len(s) + 1):
            for u in self.ending(s, p, 0):
                if (p == len(u) or last[p - len(u)] is not None) and self.joins(last[p - len(u)], u):
                    last[p] = u
                    break
        out, p = [], len(s)
        while p:
            out.append(last[p])
            p -= len(last[p])
        return out[::-1]

    # -------------------------------------------------- chunks
    def marked(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def chunks(self, s: str, size: int = CHUNK):
        """(open_left, open_right, start, end): consecutive chunks of at most
        ``size``, cut at the last safe place of each, in mid-run only where a
        chunk has none."""
        size = max(size, self.longest + 1)
        a, open_left = 0, False
        while a < len(s):
            b = min(len(s), a + size)
            if open_left:
                # only the rest of the run, so that the next cut is safe
                m = self._next_safe(s, a, b)
                b, open_right = (m, False) if m else (b, b < len(s))
                if b == len(s):
                    open_right = False
            elif b == len(s):
                open_right = False
            else:
                m = self._last_safe(s, a, b)
                b, open_right = (m, False) if m else (b, True)
            yield open_left, open_right, a, b
            a, open_left = b, open_right

    def safe(self, s: str, p: int) -> bool:
        x, y = s[p - 1], s[p]
        return (y == SPACE and x != SPACE) or x in self.alone or y in self.alone

    def _last_safe(self, s, a, b):
        return next((p for p in range(b, a, -1) if self.safe(s, p)), None)

    def _next_safe(self, s, a, b):
        return next((p for p in range(a, b + 1) if p < len(s) and self.safe(s, p)), None)

    def encode_closed(self, s: str) -> list[int]:
        """Ids of a stretch between safe cuts."""
        return list(chain.from_iterable(map(self.word_ids, self.word.findall(s))))

    def transfer(self, s: str, b0: int, b1: int, open_left: bool, open_right: bool) -> dict:
        """Transfer matrix: entry states, exit states and, per exit, the mask
        of entries of weight 0."""
        entry = self.entry_states(s, b0) if open_left else None
        nodes = self.lattice(s, b0, b1, entry, not open_right)
        if open_right:
            out = [(p - b1, u, m) for p in sorted(nodes) if p >= b1
                   for u, m in nodes[p].items() if p - len(u) < b1]
        else:
            out = [(0, u, m) for u, m in nodes.get(b1, {}).items()]
        return {"in": entry or [(0, "")], "out": [(e, u) for e, u, _ in out],
                "mask": [m for _, _, m in out]}

    def encode(self, text: str | None, size: int = CHUNK) -> list[int]:
        """One text, chunk by chunk as the distributed form does it."""
        s, ids, run = self.marked(text or ""), [], []
        for ol, opr, a, b in self.chunks(s, size):
            if not (ol or opr):
                ids += self.encode_closed(s[a:b])
                continue
            lo, hi = max(0, a - self.longest), min(len(s), b + self.longest)
            run.append((s[lo:hi], a - lo, b - lo, ol, opr))
            if not opr:
                for part, x, y in zip(run, *bounds([self.transfer(*r) for r in run])):
                    ids += chunk_ids(self, part[0], part[1], part[2], x, y)
                run = []
        return ids

    def decode(self, ids) -> str:
        """Pieces to text; invalid byte runs become U+FFFD."""
        return self.decode_many(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_many(self, flat: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of many id lists (``flat[offsets[i]:offsets[i + 1]]``): the
        pieces' bytes are gathered from one pool."""
        if self._pool is None:
            raw = [bytes([self.byte_of[i]]) if i in self.byte_of
                   else p.replace(SPACE, " ").encode("utf-8") for i, p in enumerate(self.pieces)]
            size = np.array([len(x) for x in raw])
            self._pool = (np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size)
        pool, start, size = self._pool
        n = size[flat]
        end = np.concatenate([[0], np.cumsum(n)])
        parts = []
        for a in range(0, len(flat), _GATHER):
            ids, m = flat[a:a + _GATHER], n[a:a + _GATHER]
            at = np.cumsum(m)
            parts.append(pool[np.repeat(start[ids] - (at - m), m) + np.arange(at[-1])].tobytes())
        out = b"".join(parts)
        cut = end[offsets].tolist()
        texts_ = []
        for a, b in zip(cut[:-1], cut[1:]):
            raw = out[a + 1:b] if out[a:a + 1] == b" " and a < b else out[a:b]
            texts_.append(raw.decode("utf-8", "replace"))
        return texts_


def compose(a: dict, b: dict) -> dict:
    """Max-plus product of two transfer matrices (associative)."""
    where = {tuple(s): i for i, s in enumerate(map(tuple, a["out"]))}
    masks = []
    for m in b["mask"]:
        total = 0
        for i, s in enumerate(map(tuple, b["in"])):
            if m >> i & 1 and s in where:
                total |= a["mask"][where[s]]
        masks.append(total)
    return {"in": a["in"], "out": b["out"], "mask": masks}


def bounds(run: list[dict]) -> tuple[list, list]:
    """Entry and exit state of every chunk of a run (start: None)."""
    prefix = list(accumulate(run, compose))
    ends: list[State] = [()] * len(run)
    starts: list[State | None] = [None] * len(run)
    want = next(i for i, m in enumerate(prefix[-1]["mask"]) if m)
    ends[-1] = tuple(run[-1]["out"][want])
    for k in range(len(run) - 1, 0, -1):
        i = next(i for i, s in enumerate(run[k]["out"]) if tuple(s) == ends[k])
        reach = {tuple(s) for s, m in zip(prefix[k - 1]["out"], prefix[k - 1]["mask"]) if m}
        starts[k] = next(tuple(s) for j, s in enumerate(run[k]["in"])
                         if run[k]["mask"][i] >> j & 1 and tuple(s) in reach)
        ends[k - 1] = starts[k]
    return starts, ends


def chunk_ids(pieces: Pieces, s: str, b0: int, b1: int, start: State | None, end: State) -> list[int]:
    parts = pieces.backtrace(s, b0, start, b1 + end[0], end[1])
    return list(chain.from_iterable(map(pieces.piece_ids, parts)))


# ------------------------------------------------------------ Spark
def _lists(per_row: list[list[int]]) -> pa.ListArray:
    n = np.fromiter(map(len, per_row), np.int64, len(per_row))
    flat = np.fromiter(chain.from_iterable(per_row), np.int32, int(n.sum()))
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))


def _round_trips(pieces: Pieces, ids: pa.ListArray, rows: list[str | None]) -> pa.Array:
    n = np.array(ids.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    back = pieces.decode_many(ids.flatten().to_numpy(zero_copy_only=False),
                              np.concatenate([[0], np.cumsum(n)]))
    return pa.array([a == (t or "").replace(SPACE, " ") for a, t in zip(back, rows)], pa.bool_())


def _matrix(m: dict) -> str:
    return json.dumps(m | {"mask": [format(x, "x") for x in m["mask"]]})


def _unmatrix(s: str) -> dict:
    m = json.loads(s)
    return m | {"mask": [int(x, 16) for x in m["mask"]]}


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK) -> DataFrame:
    """One row per input row: (doc_id, ids, round_trip).

    ``round_trip``: the ids decode to the text again (a text's own U+2581
    becomes a space, as in the library; null counts as empty).  Null and empty
    texts have no ids.  Texts of up to ``chunk`` code points
    are encoded where they are; longer ones are dealt out chunk by chunk.
    Repeated rows are encoded alike; other columns are left behind.
    """
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(pieces)
    src = texts(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def short(batches):
        pc = vocab.value
        for b in batches:
            for part in slices(b, 128):
                rows = part.column("text").to_pylist()
                ids = _lists([pc.encode_closed(pc.marked(t)) if t else [] for t in rows])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, _round_trips(pc, ids, rows)], names)

    def checked(batches):
        pc = vocab.value
        for b in batches:
            for part in slices(b, 16):
                ids = part.column("ids")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, _round_trips(pc, ids, part.column("text").to_pylist())],
                    names)

    def split(batches):
        pc = vocab.value
        for b in batches:
            for d, th, t in zip(b.column("d").to_pylist(), b.column("th").to_pylist(),
                                b.column("text").to_pylist()):
                s = pc.marked(t)
                rows = []
                run = -1
                for k, (ol, opr, a, e) in enumerate(pc.chunks(s, chunk)):
                    is_open = ol or opr
                    run = k if is_open and not ol else run
                    lo = max(0, a - pc.longest) if is_open else a
                    hi = min(len(s), e + pc.longest) if is_open else e
                    rows.append((d, th, k, run if is_open else None, ol, opr, a - lo, e - lo, s[lo:hi]))
                c = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(),
                         pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, y) for x, y in zip(c, types)],
                    ["d", "th", "k", "run", "ol", "opr", "a", "e", "s"])

    def closed(batches):
        pc = vocab.value
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), b.column("th"), b.column("k"),
                 _lists([pc.encode_closed(s) for s in b.column("s").to_pylist()])],
                ["d", "th", "k", "ids"])

    def matrices(batches):
        pc = vocab.value
        for b in batches:
            m = [_matrix(pc.transfer(r["s"], r["a"], r["e"], r["ol"], r["opr"])) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), b.column("th"), b.column("run"), b.column("k"), pa.array(m, pa.string())],
                ["d", "th", "run", "k", "m"])

    def states(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                ms = sorted((x["k"], x["m"]) for x in r["ms"])
                starts, ends = bounds([_unmatrix(m) for _, m in ms])
                rows += [(r["d"], r["th"], k, json.dumps([x, y]))
                         for (k, _), x, y in zip(ms, starts, ends)]
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()),
                     pa.array(c[2], pa.int32()), pa.array(c[3], pa.string())],
                    ["xd", "xth", "xk", "state"])

    def traced(batches):
        pc = vocab.value
        for b in batches:
            ids = []
            for r in b.to_pylist():
                x, y = json.loads(r["state"])
                ids.append(chunk_ids(pc, r["s"], r["a"], r["e"], tuple(x) if x else None, tuple(y)))
            yield pa.RecordBatch.from_arrays(
                [b.column("d"), b.column("th"), b.column("k"), _lists(ids)], ["d", "th", "k", "ids"])

    giant = F.coalesce(F.length("text"), F.lit(0)) >= chunk
    names, out = ["doc_id", "ids", "round_trip"], f"doc_id {kind}, ids array<int>, round_trip boolean"
    small = src.filter(~giant).select("doc_id", "text").mapInArrow(freed(short), out)
    big = src.filter(giant)
    parts = (big.select("d", "th", "text").dropDuplicates(["d", "th"]).mapInArrow(
        freed(split), "d long, th long, k int, run int, ol boolean, opr boolean, a int, e int, s string")
        .repartition(spark_partitions(spark), "d", "th", "k"))
    whole = parts.filter("run is null").select("d", "th", "k", "s").mapInArrow(
        freed(closed), "d long, th long, k int, ids array<int>")
    opened = parts.filter("run is not null")
    # a run's matrices: a few hundred bytes per chunk of one document
    known = (opened.mapInArrow(freed(matrices), "d long, th long, run int, k int, m string")
             .groupBy("d", "th", "run").agg(F.collect_list(F.struct("k", "m")).alias("ms"))
             .mapInArrow(freed(states), "xd long, xth long, xk int, state string"))
    cut_ids = (opened.join(known, (F.col("d") == F.col("xd")) & (F.col("th") == F.col("xth"))
                           & (F.col("k") == F.col("xk")))
               .select("d", "th", "k", "a", "e", "s", "state")
               .mapInArrow(freed(traced), "d long, th long, k int, ids array<int>"))
    # a document's own chunks only: one output row holds them all anyway
    joined = (whole.unionByName(cut_ids).groupBy("d", "th")
              .agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
              .select(F.col("d").alias("xd"), F.col("th").alias("xth"),
                      F.flatten(F.col("parts.ids")).alias("ids")))
    large = (big.join(joined, (F.col("d") == F.col("xd")) & (F.col("th") == F.col("xth")))
             .select("doc_id", "text", "ids").mapInArrow(freed(checked), out))
    return small.unionByName(large)


def spark_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def decode(rows: DataFrame, pieces: Pieces, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``; null ids decode to null, empty ones to "".

    A text's own U+2581 decodes to a space, as in the library."""
    vocab = rows.sparkSession.sparkContext.broadcast(pieces)
    names = [c for c in rows.columns if c != "decoded"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)

    def run(batches):
        pc = vocab.value
        for b in batches:
            for part in slices(b):
                ids = part.column(ids_col)
                flat = ids.flatten().to_numpy(zero_copy_only=False)
                n = np.array(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
                text = pc.decode_many(flat, np.concatenate([[0], np.cumsum(n)]))
                text = pa.array(text, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*names, "decoded"])
    return rows.select(*[f"`{c}`" for c in names]).mapInArrow(freed(run), schema + ", decoded string")
