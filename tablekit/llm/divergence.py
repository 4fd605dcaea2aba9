"""Source divergence audit over a three-dimensional cube.

Each language has groups (its sources) and kept terms.  A group's share of a
term is p = 1 + floor(10**9 (count + 5) / (N + 5 V)), and two groups diverge by
the sum of |p - q| over the kept terms.  The work is the cube (groups x groups
x terms).  It is cut into cells (group block, group block, term block) of
``GROUPS`` groups and about ``TERMS`` terms.  Every share is replicated to the
cells of its group block, a task adds up the partial divergences of the pairs
of its cell, and a sum along the term axis ends it.

Counts are sparse: a group without a term has the share p0 that count 0 gives.
A cell adds |p - q| - |p0 - q0| over the terms it holds, and V |p0 - q0| is
added once a pair, so absent terms need no rows.

Only counts leave the text scan: a task adds up its (language, source, term)
occurrences before the shuffle, so a source with a third of all rows is many
partial rows of a bounded vocabulary, never a group of texts.

Null text, language and source count as ''.  Repeated rows are documents of
their own; ties rank by the item's UTF-8 bytes; other columns are left behind;
an empty table gives no rows, and a language whose terms are all rare gives
pairs of value 0.  Long texts are split ``_WINDOW`` bytes at a time.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, slices, written
from .words import utf8

#: Groups and terms (about) of a cell: its matrices take 8 bytes an entry.
GROUPS = 32
TERMS = 4096
#: Distinct (language, source, term) rows that a task holds.
ROOM = 400_000
_WINDOW = 1 << 20

#: A-Z folded, other ASCII but a-z made a space; bytes of other characters stay.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                 for b in range(256))


def _text_terms(text: str) -> Counter:
    """Occurrences of a text's terms."""
    raw = utf8(text).translate(_LETTERS)
    found, at = Counter(), 0
    while at < len(raw):
        stop = raw.find(b" ", at + _WINDOW)
        stop = len(raw) if stop < 0 else stop
        found.update(raw[at:stop].split())
        at = stop
    return found


def _count(room: int):
    """Task: (lang, source, text) batches -> partial (lang, source, term, n,
    docs); a null term stands for the group itself."""
    def rows(held):
        cols = list(zip(*((a, s, t, n, d) for (a, s), terms in held.items()
                          for t, (n, d) in terms.items())))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
             pa.array(cols[2], pa.binary()).cast(pa.string()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
            ["lang", "source", "term", "n", "docs"])

    def run(batches):
        held: dict = {}
        size = 0
        for batch in batches:
            for b in slices(batch, 128):
                for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                    terms = held.get((lang, source))
                    if terms is None:
                        terms = held[lang, source] = {None: (0, 0)}
                    before = len(terms)
                    for t, n in _text_terms(text).items():
                        old = terms.get(t)
                        terms[t] = (n, 1) if old is None else (old[0] + n, old[1] + 1)
                    size += len(terms) - before
                    if size > room:
                        yield rows(held)
                        held, size = {}, 0
        if held:
            yield rows(held)
    return run


def _share(n, total, kept):
    """1 + floor(10**9 (n + 5) / (total + 5 kept)), exactly."""
    big = "decimal(24,0)"
    return F.expr(f"1 + (cast(1000000000 as decimal(10,0)) * cast({n} + 5 as {big}))"
                  f" div cast({total} + 5 * {kept} as {big})")


def _cell(pdf: pd.DataFrame, groups: int) -> pd.DataFrame:
    """Partial divergences of the pairs of one cell.  Every group of the cell
    also comes as a row without a term, so no pair is missing; term block 0
    adds what the pair would have if it had no terms at all."""
    lang, bi, bj, tb, v = (pdf[c].iat[0] for c in ("lang", "bi", "bj", "tb", "v"))
    term = pd.factorize(pdf["term"])[0]
    n = term.max() + 1

    def slab(block):
        mine = (pdf["g"] // groups == block).to_numpy()
        who, at, idx = np.unique(pdf["g"].to_numpy()[mine], return_index=True, return_inverse=True)
        p0 = pdf["p0"].to_numpy()[mine][at]
        p = np.repeat(p0[:, None], n, axis=1)
        t = term[mine]
        p[idx[t >= 0], t[t >= 0]] = pdf["p"].to_numpy()[mine][t >= 0]
        return who, p0, p

    a, a0, p = slab(bi)
    b, b0, q = (a, a0, p) if bi == bj else slab(bj)
    left, right, value = [], [], []
    for i in range(len(a)):
        ok = b > a[i]
        part = np.abs(q[ok] - p[i]).sum(axis=1) + ((v if tb == 0 else 0) - n) * np.abs(b0[ok] - a0[i])
        left.append(np.full(ok.sum(), a[i]))
        right.append(b[ok])
        value.append(part)
    return pd.DataFrame({"lang": lang, "g1": np.concatenate(left), "g2": np.concatenate(right),
                         "part": np.concatenate(value)})


def divergence(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source", block_groups: int = GROUPS,
               block_terms: int = TERMS, room: int = ROOM) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of the
    language by divergence (part ``pair``), and the terms that a source uses
    more than its language does (part ``term``, the first ``top_terms``)."""
    src = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(a) for c, a in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = written(
        src.mapInArrow(freed(_count(room)), "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "divergence-counts")

    # kept terms of a language with their block, and what counts sum to
    kept = (counts.filter("term is not null").groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", F.col("n").alias("all_n")))
    kept = written(kept, "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("all_total"))
    used = counts.join(kept, ["lang", "term"])
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # groups are numbered within their language
    order = Window.partitionBy("lang").orderBy("source")
    groups = (counts.filter("term is null").select("lang", "source")
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                      F.coalesce("v", F.lit(0)).alias("v"), "all_total",
                      (F.row_number().over(order) - 1).alias("g"))
              .withColumn("p0", F.when(F.col("v") > 0, _share("0", "total", "v")).otherwise(0)))
    groups = written(groups, "divergence-groups")
    shares = written(
        used.join(groups, ["lang", "source"])
        .select("lang", "source", "term", "g", "v", "p0", _share("n", "total", "v").alias("p"),
                _share("all_n", "all_total", "v").alias("q")), "divergence-shares")

    blocks = (groups.groupBy("lang", "v").agg(F.max("g").alias("last"))
              .select("lang", F.expr(f"cast(last div {block_groups} as int)").alias("last"),
                      F.expr(f"cast(greatest(1, (v + {block_terms} - 1) div {block_terms}) as int)").alias("slabs")))
    # slices: the shares of a group block and term block, and one row without a
    # term for each of the block's groups in every term block
    rows = (shares.join(blocks, "lang").select(
        "lang", "g", "term", "p", "p0", "v", "last",
        F.expr("cast(pmod(xxhash64(term), slabs) as int)").alias("tb"))
        .unionByName(groups.join(blocks, "lang").select(
            "lang", "g", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "p0", "v", "last",
            F.explode(F.expr("sequence(0, slabs - 1)")).alias("tb"))))
    cells = (rows.withColumn("mine", F.expr(f"cast(g div {block_groups} as int)"))
             .withColumn("other", F.explode(F.expr("sequence(0, last)")))
             .select("lang", F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"),
                     "tb", "g", "term", "p", "p0", "v"))
    parts = (cells.groupBy("lang", "bi", "bj", "tb").applyInPandas(
        lambda pdf: _cell(pdf, block_groups), "lang string, g1 int, g2 int, part long")
        .groupBy("lang", "g1", "g2").agg(F.sum("part").alias("value")))
    one = groups.select("lang", "source", F.col("g").alias("g1"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("g2"))
    pairs = parts.join(one, ["lang", "g1"]).join(two, ["lang", "g2"])
    pairs = pairs.select("lang", F.explode(F.array(
        F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
        .alias("s"), "value").select("lang", "s.source", "s.item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best)
    terms = (shares.filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                           (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", rank).filter(F.col("rank") <= top_terms))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).select(cols)
            .unionByName(terms.withColumn("part", F.lit("term")).select(cols)))
