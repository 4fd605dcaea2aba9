"""Registered queries and the pipeline over the driver's small tables."""

from __future__ import annotations

import re
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from tablekit.llm.queries import QUERIES, oracles
from tests.conftest import SF_SMALL
from tests.oracle_check import check, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(oracles()))
def test_sql_twin(spark, con, key):
    line = check(spark, con, key, QUERIES[key], oracles()[key], SF_SMALL)
    assert line.startswith("OK"), line


def test_pipeline(spark, con, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        if k < 4:
            assert out.columns == list(corpus_pipeline.COLUMNS), name
        out.write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        assert 0 < docs.count() <= n, name
        n = docs.count()
    assert docs.filter("not round_trip").count() == 0


def test_pipeline_stages_on_hostile_rows(spark, tmp_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, th long"
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, text), (4, text), (4, text), (None, text + " x"), (None, None)]
    docs = spark.createDataFrame([(i, t, None, None, None, 5) for i, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).collect()
        stage(spark, docs.limit(0), SF_SMALL).collect()
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()
    assert sorted((r["doc_id"] or -1, (r["text"] or "")[:2]) for r in kept)[0][0] in (-1, 1)
    assert sum(r["text"] == text for r in kept) == 1


def test_pipeline_decontamination_matches_brute_force(spark):
    def words(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    windows = {tuple(w[i:i + 10]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
               for w in [words(r["text"])] if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    clean = Counter((r["doc_id"], r["text"]) for r in docs.collect() for w in [words(r["text"])]
                    if not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1)))
    got = corpus_pipeline.decontamination(spark, docs, SF_SMALL).collect()
    assert 0 < len(got) < docs.count() and Counter((r["doc_id"], r["text"]) for r in got) == clean


def _rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_pipeline_near_duplicates_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")

    def fingerprint(text):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    rows = sorted(_rows(docs))
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                group[b] = a  # the smallest id leads
    want = sorted(r for i, r in enumerate(rows) if root(i) == i)
    got = sorted(_rows(corpus_pipeline.near_duplicates(spark, docs, SF_SMALL)))
    assert got == want and len(want) < len(rows)


def test_pipeline_substring_duplicates_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted(_rows(docs))
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    want = []
    for i, text in rows:
        w = words[i]
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < i for p in range(k, k + 13)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        if not gone:
            want.append((i, text))
        elif kept:
            want.append((i, kept))
    got = _rows(corpus_pipeline.substring_duplicates(spark, docs, SF_SMALL))
    assert sorted(got) == sorted(want) and got != rows
