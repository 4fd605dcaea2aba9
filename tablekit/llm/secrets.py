"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

Base spans come from three patterns (``assign``, ``access``, ``hex``).  The
method adds ``novel`` spans: strings of 16 or more key characters, letters and
digits among them, that stand within ``NEAR`` code points after a sensitive
word and that zstandard cannot compress.  A candidate's novelty is the bytes
it adds to a frame that already holds the text around it (``AROUND`` code
points on each side), per character, with the corpus's own identifiers as the
compressor's dictionary.  Names that the corpus or the surrounding code uses
cost little; random keys cost what their alphabet holds (measured: 1.0 up to
40 characters, hexadecimal digits 0.75 to 0.8 from 64 on).  ``NOVEL`` bytes a
character or more are reported.  Candidates that overlap a base span are not
reported again.

The dictionary is counted over all texts: the identifiers (letters and
underscores, no digits, so that a leaked key that was copied into thousands of
documents never becomes a known word) that would save most bytes.  Its size is
a parameter of the compressor (``DICT_BYTES``), whatever the input.

Null and empty texts have no spans.  Every row is judged by its own text, so
repeated rows give equal rows and ties do not arise; other columns are left
behind.  Work per text is linear in its length.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, slices
from .words import utf8

# patterns fixed by the contract
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|auth|bearer|credential|private"
                       r"|signature|session", re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_MIXED = re.compile(r"[A-Za-z][+/_-]*[0-9]|[0-9][+/_-]*[A-Za-z]")
NEAR = 48
AROUND = 256
NOVEL = 0.7
#: Bytes of the compressor's dictionary, and identifiers the driver takes for it.
DICT_BYTES = 1 << 16
DICT_WORDS = 1 << 13
#: Distinct identifiers that a task holds, and bytes split at a time.
ROOM = 200_000
_WINDOW = 1 << 20
_BLOCK_HEADER = 3
_PARTS = 64
_NAME = bytes(b if chr(b).isascii() and (chr(b).isalnum() or b == 0x5F) else 0x20 for b in range(256))


def _names(text: str):
    """Lists of a text's identifiers: runs of letters, digits and underscores."""
    raw = utf8(text).translate(_NAME)
    at = 0
    while at < len(raw):
        stop = raw.find(b" ", at + _WINDOW)
        stop = len(raw) if stop < 0 else stop
        yield raw[at:stop].split()
        at = stop


def _count(batches):
    """Task: texts -> partial (name, n)."""
    held: Counter = Counter()

    def rows():
        found = [(w, n) for w, n in held.items()
                 if 4 <= len(w) <= 64 and not any(0x30 <= c <= 0x39 for c in w)]
        name, n = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(name, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["name", "n"])
    for batch in batches:
        for b in slices(batch, 128):
            for text in b.column("text").to_pylist():
                for names in _names(text or ""):
                    held.update(names)
            if len(held) > ROOM:
                yield rows()
                held.clear()
    yield rows()


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = DICT_BYTES) -> bytes:
    """The identifiers of all texts that would save most bytes, the best last
    (where matches are cheapest), in at most ``size`` bytes.  The best of each
    of ``_PARTS`` parts come first, so what reaches the driver does not grow
    with the number of partitions."""
    names = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(freed(_count), "name string, n long")
             .groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1")
             .select("name", (F.col("n") * (F.length("name") - 3)).alias("saved"),
                     F.pmod(F.xxhash64("name"), F.lit(_PARTS)).alias("part"))
             .withColumn("place", F.row_number().over(
                 Window.partitionBy("part").orderBy(F.desc("saved"), "name")))
             .filter(F.col("place") <= DICT_WORDS).orderBy(F.desc("saved"), "name").limit(DICT_WORDS).collect())
    out, used = [], 0
    for r in names:
        used += len(r["name"]) + 1
        if used > size:
            break
        out.append(r["name"])
    return " ".join(reversed(out)).encode()


class Novelty:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, dictionary: bytes):
        known = {}
        if len(dictionary) >= 8:
            known["dict_data"] = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known["dict_data"].precompute_compress(level=3)
        self.frame = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False,
                                              write_dict_id=False, **known).compressobj

    def of(self, text: str, start: int, end: int) -> float:
        """Bytes per character that ``text[start:end]`` adds to a frame that
        holds what stands around it: a block of its own, less its header."""
        frame = self.frame()
        frame.compress(utf8(text[max(0, start - AROUND):start] + "\n" + text[end:end + AROUND]))
        frame.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)
        size = len(frame.compress(utf8(text[start:end])))
        size += len(frame.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK))
        return (size - _BLOCK_HEADER) / (end - start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novel_spans(text: str, base, novelty: Novelty, least: float = NOVEL) -> list[tuple[int, int, int]]:
    """(start, kind, end) of incompressible strings in a sensitive context."""
    if not SENSITIVE.search(text):
        return []
    out, i, covered = [], 0, -1
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while i < len(base) and base[i][0] < e:
            covered = max(covered, base[i][2])
            i += 1
        if covered > s or not _MIXED.search(m.group()) or not SENSITIVE.search(text, max(0, s - NEAR), s):
            continue
        if novelty.of(text, s, e) >= least:
            out.append((s, 3, e))
    return out


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, dictionary: bytes | None = None, id_col: str = "doc_id",
                 text_col: str = "text", least: float = NOVEL) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_novel, base, spans): counts, and
    spans as ``kind:start:end`` in code points, by start and kind."""
    if dictionary is None:
        dictionary = identifier_dictionary(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        novelty = Novelty(shared.value)
        for batch in batches:
            for b in slices(batch):
                counts, base_, spans_ = np.zeros((4, b.num_rows), np.int64), [], []
                for row, text in enumerate(b.column("text").to_pylist()):
                    base = base_spans(text or "")
                    new = novel_spans(text or "", base, novelty, least)
                    for _, k, _ in base + new:
                        counts[k, row] += 1
                    base_.append(_listed(base))
                    spans_.append(_listed(sorted(base + new)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *map(pa.array, counts), pa.array(base_, pa.string()),
                     pa.array(spans_, pa.string())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])
    return src.mapInArrow(
        freed(scan), f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string")
