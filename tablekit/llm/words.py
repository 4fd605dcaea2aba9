"""Word splitting and word-sequence hashing on UTF-8 bytes.

``bytes.split()`` cuts at exactly U+0020 and U+0009-U+000D, and
``bytes.lower()`` folds A-Z only, so both match the contracts' classes
``[^\\x20\\x09-\\x0D]+`` and "lower-case A-Z" without a regular expression.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .common import freed

#: For ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on A-Z lower-cased text: every
#: other ASCII byte becomes a space, bytes of non-ASCII characters stay.
_ALNUM = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower()
    else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))

_MUL = np.uint64(0xD6E8FEB86659FD93)


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space; none for null."""
    return utf8(text).split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return utf8(text).translate(_ALNUM).split() if text else []


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A random 64-bit number for every byte (fixed seed).
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 64, 256, dtype=np.uint64)
#: Bytes hashed at a time; words above LONG bytes are hashed on their own, as
#: polynomials modulo 2**64 collide for some long words whatever their base.
_SLICE = 1 << 20
_LONG = 64


def locate(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words between ASCII white space."""
    space = np.ones(len(buf) + 2, bool)
    space[1:-1] = _IS_SPACE[np.frombuffer(buf, np.uint8)]
    return (np.flatnonzero(space[:-1] & ~space[1:]),
            np.flatnonzero(~space[:-1] & space[1:]))


def hash_words(buf: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at these byte ranges, in slices of bounded
    size: polynomials over the bytes from one running sum a slice."""
    out = np.empty(len(starts), np.uint64)
    long = np.flatnonzero(ends - starts > _LONG)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SLICE)))
        if j == i + 1 and ends[i] - starts[i] > _LONG:
            i = j
            continue
        low = int(starts[i])
        part = RangeHasher(_BYTE[np.frombuffer(buf, np.uint8, int(ends[j - 1]) - low, low)])
        out[i:j] = part.of(starts[i:j] - low, ends[i:j] - low)
        i = j
    for k in long:
        out[k] = xxhash.xxh64_intdigest(buf[starts[k]:ends[k]])
    return out


class Block:
    """Texts hashed together: ``rows[i]``'s words are ``lo[i]:hi[i]`` of the
    block's byte ranges and hashes."""

    def __init__(self, rows: list[int], parts: list[bytes]):
        self.rows = np.array(rows)
        self.buf = b" ".join(parts)
        self.starts, self.ends = locate(self.buf)
        self.h = hash_words(self.buf, self.starts, self.ends)
        stop = np.cumsum([len(p) + 1 for p in parts])
        self.hi = np.searchsorted(self.starts, stop)
        self.lo = np.concatenate([[0], self.hi[:-1]])

    def words(self, a: int, b: int) -> list[str]:
        return [self.buf[s:e].decode("utf-8", "replace")
                for s, e in zip(self.starts[a:b], self.ends[a:b])]


def blocks(texts, alnum: bool = False, size: int = 1 << 21):
    """Blocks of about ``size`` bytes over a list of texts (nulls: no words);
    a longer text is a block of its own.  ``alnum``: words of ``alnum_words``
    instead of ``space_words``."""
    rows, parts, total = [], [], 0
    for i, t in enumerate(texts):
        raw = utf8(t) if t else b""
        if alnum:
            raw = raw.translate(_ALNUM)
        if rows and total + len(raw) > size:
            yield Block(rows, parts)
            rows, parts, total = [], [], 0
        rows.append(i)
        parts.append(raw)
        total += len(raw)
    if rows:
        yield Block(rows, parts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes (bijective, vectorised)."""
    h = (h ^ (h >> np.uint64(32))) * _MUL
    h = (h ^ (h >> np.uint64(32))) * _MUL
    return h ^ (h >> np.uint64(32))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _INVERSE)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0], _POWERS[1]


class RangeHasher:
    """Hashes of any word runs of an array of word hashes from one running
    sum: the run's polynomial, shifted to its start."""

    def __init__(self, h: np.ndarray):
        up, self.down = _powers(len(h) + 1)
        self.n = len(h)
        self.total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[:len(h)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts]
                   + (ends - starts).astype(np.uint64) * _MUL)

    def every(self, k: int) -> np.ndarray:
        """Every run of k consecutive words."""
        n = self.n - k + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.total[k:] - self.total[:n]) * self.down[:n]
                   + np.uint64(int(k) * int(_MUL) & (1 << 64) - 1))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class BitSet:
    """A fixed number of bits that hashes are tested against.

    Its size never depends on the data; more members only let more rows
    through a filter that a later exact join settles."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        bit = h & self.mask
        return (self.words[(bit >> np.uint64(6)).astype(np.int64)]
                >> (bit & np.uint64(63))) & np.uint64(1) != 0


#: Bits of a block of a bit set, as one row that the driver takes (64 KB).
_BLOCK_LOG2 = 19


def bit_set(rows, columns: list[str], hashes, log2: int) -> np.ndarray:
    """The words of a ``BitSet`` of ``2**log2`` bits over all rows.

    ``hashes`` gets the columns as arrays and returns unsigned hashes.  Tasks
    send distinct bit places, each block of the set is put together in one
    place, and the driver takes the finished blocks: ``2**log2 / 8`` bytes,
    whatever the input."""
    import pyarrow as pa
    inner = min(log2, _BLOCK_LOG2)

    def places(batches):
        for b in batches:
            h = hashes(*(b.column(c).to_numpy() for c in columns))
            at = np.unique(h & np.uint64((1 << log2) - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> inner).astype(np.int32)),
                 pa.array((at & ((1 << inner) - 1)).astype(np.int32))], ["block", "at"])

    def blocks_(batches):
        sets: dict[int, np.ndarray] = {}
        for b in batches:
            block, at = b.column("block").to_numpy(), b.column("at").to_numpy()
            for k in np.unique(block).tolist():
                sets.setdefault(k, np.zeros(1 << inner, bool))[at[block == k]] = True
        if sets:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sets), pa.int32()),
                 pa.array([np.packbits(x, bitorder="little").tobytes() for x in sets.values()], pa.binary())],
                ["block", "bits"])

    n = min(1 << (log2 - inner), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    got = (rows.select(*columns).mapInArrow(freed(places), "block int, at int").repartition(n, "block")
           .mapInArrow(freed(blocks_), "block int, bits binary").collect())
    out = np.zeros((1 << log2) // 8, np.uint8)
    size = (1 << inner) // 8
    for r in got:
        out[r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out.view("<u8")
