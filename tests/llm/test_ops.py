"""Operators on small frames: brute force, round trips, hostile rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablekit.llm import chat, decontam, langid, quality, sentencepiece, sharding, simhash, substring, toxicity, urls
from tablekit.llm.components import connected_components
from tablekit.llm.queries import piece_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d long, th long, w string, a int"
LONG = "alpha beta gamma " * 4000


def frame(spark, rows, n=3):
    """Documents with columns whose names clash with the operators' own."""
    full = [(i, t, "en", "s", None if t is None else len(t), 7, 8, "x", 1) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(n)


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def hostile(spark):
    same = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    return frame(spark, [(1, None), (2, ""), (3, " \n\t"), (4, same), (5, same), (5, same), (None, same),
                         (None, None), (6, LONG), (7, "日本語 🎉 ▁x"), (8, "x" * 50_000)])


PAGES = "page_id long, url string, html string, host string, rule string, key long"
MODEL = None


def pieces():
    global MODEL
    MODEL = MODEL or piece_model()
    return MODEL


def run_all(spark, docs, bench):
    """name -> result over the documents-shaped operators."""
    model = toxicity.fit_toxicity(docs.select("text", F.lit(0).alias("y")))
    langs = langid.fit_languages(docs.select("text", "lang"))
    return {
        "toxicity": toxicity.score_toxicity(docs, model),
        "simhash": simhash.simhash_groups(docs),
        "sentencepiece": sentencepiece.encode(docs, pieces(), chunk=2000),
        "quality": quality.quality(docs),
        "langid": langid.identify_language(docs, langs),
        "decontam": decontam.decontaminate(docs, bench),
        "sharding": sharding.shard(docs),
        "substring": substring.substring_dedup(docs),
    }


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, None),
                                  (3, ""), (4, "Alpha, beta"), (4, "Alpha, beta"), (None, "fourteen")],
                                 "item_id long, text string")


def test_hostile_rows_keep_every_row(spark, bench):
    docs = hostile(spark)
    for name, df in run_all(spark, docs, bench).items():
        got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())
        assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect()), name


def test_empty_tables(spark, bench):
    docs = hostile(spark).limit(0)
    for name, df in run_all(spark, docs, bench.limit(0)).items():
        assert df.collect() == [], name
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert urls.judge_urls(spark.createDataFrame([], PAGES)).count() == 0


def test_hostile_results(spark, bench):
    docs = hostile(spark)
    q = {(r["doc_id"], r["n_words"]): r for r in quality.quality(docs).collect()}
    assert q[6, 12000]["n_repeat_words"] == 12000 and q[6, 12000]["base_failed"]
    assert q[1, 0]["base_failed"] and not q[1, 0]["kept"]
    hit = {r["doc_id"]: r for r in decontam.decontaminate(docs, bench).collect() if r["doc_id"]}
    assert hit[4]["n_hit"] == 12 and hit[4]["items"] == ["1"]  # the null item lists nothing
    assert hit[6]["n_hit"] == 8000 and hit[6]["items"] == ["4"] and hit[1]["n_hit"] == 0
    cut = [(r["doc_id"], r["n_removed"]) for r in substring.substring_dedup(docs).collect()]
    assert sorted(x for x in cut if x[0]) == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 14), (5, 14), (6, 0), (7, 0), (8, 0)]
    assert sorted(n for i, n in cut if i is None) == [0, 14]
    lang = {r["doc_id"]: r["best"] for r in langid.identify_language(
        docs, langid.fit_languages(docs.select("text", "lang"))).collect() if r["doc_id"]}
    assert lang[1] == lang[2] == lang[3] == "und" and lang[6] == "en"


# ------------------------------------------------------------ toxicity
def brute_segments(s):
    """Maximal scoring segments by their recursive definition."""
    if len(s) == 0 or max(s) <= 0:
        return []
    best = max(((sum(s[a:b]), -a, b - a) for a in range(len(s)) for b in range(a + 1, len(s) + 1)),
               key=lambda x: (round(x[0], 9), -x[2], x[1]))
    a = -best[1]
    b = a + best[2]
    return brute_segments(s[:a]) + [(a, b)] + [(a2 + b, b2 + b) for a2, b2 in brute_segments(s[b:])]


def test_maximal_segments():
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.choice([-5, -4, -3, -2, -1, 1, 2, 3, 5]) + rng.random() / 7 for _ in range(rng.randrange(0, 14))]
        assert [x[:2] for x in toxicity.maximal_segments(np.array(s))] == brute_segments(s)


def test_toxicity_held_out(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        t = words(rng, 60).split()
        bad = i % 5 == 0
        if bad:
            t[20:20] = [f"vile{rng.choice('abcdefgh')}{rng.randrange(30)}" for _ in range(3)]
        rows.append((i, " ".join(t), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    model = toxicity.fit_toxicity(df.filter("doc_id % 7 != 0"))
    got = toxicity.score_toxicity(df.filter("doc_id % 7 = 0"), model).collect()
    assert all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in got)
    assert all(len(r["passages"]) >= 1 for r in got if r["predicted"])
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert [(r["doc_id"], r["y"]) for r in toxicity.labelled(df, labels).collect()] == [(1, 1)]


def test_toxicity_of_a_common_word_that_no_clean_text_has():
    for toxic, clean in ((5, 0), (0, 5), (4000, 0), (0, 4000), (40_000_000, 0), (3900, 100)):
        rows = [(n, toxic, clean) for n in toxicity.nodes(b"disgusting")]
        got = toxicity._share_scores(rows, 40_100_000, 360_000_000)
        a, b = Fraction(401_000_005, 4_001_000_010), Fraction(3_600_000_005, 4_001_000_010)
        base = a / b
        for node, _, _ in rows:
            a, b = (toxic + 2 * a) / (toxic + clean + 2), (clean + 2 * b) / (toxic + clean + 2)
            odds = a / b / base
            want = toxicity.math.log(odds.numerator) - toxicity.math.log(odds.denominator)
            assert got[node] == pytest.approx(want, rel=1e-9), (toxic, clean, node)


def test_toxicity_is_fitted_where_a_word_is_in_thousands_of_toxic_texts(spark):
    df = spark.range(8000).selectExpr(
        "id AS doc_id", "cast(id % 2 AS int) AS y",
        "concat('plain words of text ', id % 50, if(id % 2 = 1, ' disgusting', '')) AS text")
    model = toxicity.fit_toxicity(df)
    low, high = model.token_score(b"disgus"), model.token_score(b"disgusting")
    assert 20 < low < 30 < high < 50 and model.token_score(b"words") == 0
    got = toxicity.score_toxicity(df.filter("doc_id < 40"), model).collect()
    assert [r["predicted"] for r in got if r["doc_id"] % 2] == [1] * 20
    assert [r["predicted"] for r in got if not r["doc_id"] % 2] == [0] * 20


def test_toxicity_keeps_every_significant_word(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_NODES", 5, raising=False)
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 200)
    sizes = []
    fit = toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y: sizes.append(len(x)) or fit(x, y))
    rng = random.Random(11)
    # one clean text is half of the rows; every toxic word occurs in six documents
    rows = [(i, words(random.Random(0), 40), 0) for i in range(600)]
    for i in range(600, 1200):
        t = words(rng, 40).split()
        if i < 720:
            t[9:9] = [f"{chr(97 + (i - 600) // 6)}qzvile"] * 3
        rows.append((i, " ".join(t), int(i < 720)))
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    model = toxicity.fit_toxicity(df)
    assert all(model.token_score(f"{chr(97 + k)}qzvile".encode()) > 1 for k in range(20))
    assert 150 <= sizes[0] <= 200


def test_new_words_of_a_text_are_looked_up_together():
    calls = []

    class Hashes(np.ndarray):
        def searchsorted(self, *args, **kw):
            calls.append(1)
            return np.asarray(self).searchsorted(*args, **kw)
    score = {b"qzv*": 1.5, b"qzvile": -2.0, b"ab": 3.0, "éàü*".encode(): 0.5}
    hashes = np.array([toxicity.xxhash.xxh64_intdigest(k) for k in score], np.uint64).view(Hashes)
    model = toxicity.ToxicityModel(toxicity.NodeScores(hashes, np.array(list(score.values()))))
    rng = random.Random(2)
    ws = [w.encode() for w in ("qzvile", "qzvil", "qzv", "ab", "abc", "éàüx", "éàü", "日本")]
    ws += [words(rng, 1).encode() + str(i).encode() for i in range(500)] + ws
    deepest = [next((score[n] for n in reversed(toxicity.nodes(w)) if n in score), 0.0) for w in ws]
    for room in (3, 1000):
        cache, want = model.cached(room), []
        total = model.evidence(b" ".join(ws).decode(), cache)[0]
        assert len(calls) == 1 and len(cache) <= room
        s = np.array(deepest) - toxicity.DRIFT
        for a, b, x in toxicity.maximal_segments(s):
            want.append(max(0.0, model.lam * x - model.log_k - toxicity.math.log(len(ws))))
        assert total == pytest.approx(sum(want))
        assert [model.token_score(w) for w in ws[:8]] == deepest[:8]
        calls.clear()
    empty = toxicity.ToxicityModel(toxicity.NodeScores(np.empty(0, np.uint64), np.empty(0)))
    assert empty.evidence("some words", empty.cached()) == (0.0, [])


# ------------------------------------------------------------ simhash
def brute_fingerprint(text):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
         .replace("\n", " ").split(" ") if x]
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint(spark):
    for t in (None, "", "A", "a B", "Été a b c", "x y z\nx y z x y z", words(random.Random(2), 300)):
        assert simhash.fingerprint(t) == brute_fingerprint(t)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_match_brute_force(spark, max_bits):
    rng = random.Random(max_bits)
    fps = set()
    for _ in range(12):  # crowds of near fingerprints, dense and chained
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(25):
            fps.add(base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))))
    fps |= {rng.getrandbits(64) for _ in range(150)} | {0}
    fps = sorted(f - 2**64 if f >= 2**63 else f for f in (x & (2**64 - 1) for x in fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= max_bits:
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in connected_components(simhash.linked_fingerprints(df, max_bits)).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_crowd_takes_the_fixed_cost_route(spark, monkeypatch):
    """The same components whether fingerprints are probed or in a crowd."""
    rng = random.Random(9)
    base = rng.getrandbits(62)
    fps = sorted({base ^ sum(1 << rng.randrange(62) for _ in range(rng.randrange(0, 6))) for _ in range(150)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    runs = []
    for ball in (0, 1000):
        monkeypatch.setattr(simhash, "BALL", ball)
        runs.append(sorted(map(tuple, connected_components(simhash.linked_fingerprints(df)).collect())))
    assert runs[0] == runs[1] and runs[0]


def test_components_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(500, x) for x in range(200, 240)] + [(7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {k: v for k, v in got.items() if k < 165} == {k: 100 for k in range(101, 161)}
    assert got[500] == 200 and got[239] == 200 and 7 not in got


# ------------------------------------------------------------ sentencepiece
def test_encode_equals_library(spark):
    import public_tokenizers
    import sentencepiece as lib
    sp = lib.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(5)
    alphabets = ["aeinorst lhd\n\t ▁éÉ日本🎉ThE.,'<0x41>", "aeinrst", " a", "the ", "lloo", "  "]
    texts_ = ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (0, 1, 7, 60, 400, 3000)]
    for t in texts_:
        want = sp.encode(t)
        assert pieces().encode(t) == want
        if len(t) <= 400:
            assert pieces().encode(t, 20) == want and pieces().encode(t, 45) == want
        assert pieces().decode(want) == sp.decode(want)
    docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in sentencepiece.encode(docs, pieces(), chunk=64).collect()}
    for i, t in enumerate(texts_):
        assert got[i]["ids"] == sp.encode(t) and got[i]["round_trip"]
    back = sentencepiece.decode(sentencepiece.encode(docs, pieces(), chunk=64), pieces()).collect()
    assert all(r["decoded"] == texts_[r["doc_id"]].replace("▁", " ") for r in back)


def test_transfer_is_associative():
    s = pieces().marked("aeinrstllooe" * 20)
    n = pieces().longest
    cuts = [0, 40, 90, 150, len(s)]
    m = [pieces().transfer(s[max(0, a - n):b + n], min(a, n), b - max(0, a - n), a > 0, b < len(s))
         for a, b in zip(cuts, cuts[1:])]
    c = sentencepiece.compose
    assert c(c(c(m[0], m[1]), m[2]), m[3]) == c(m[0], c(m[1], c(m[2], m[3])))


# ------------------------------------------------------------ language, shards
def test_kneser_ney_sums_to_one():
    u = langid.units("the cat sat on the mat and the dog sat on the log")
    keys, counts = np.unique(langid.ngrams(u), return_counts=True)
    m = langid.CharModel(keys, counts)
    symbols = np.unique(u).astype(np.uint64)
    ctx = keys[5] >> np.uint64(16)
    p = np.exp(m.logp((ctx << np.uint64(16)) | symbols)).sum()
    assert 0.9 < p <= 1 + 1e-9


def test_language_held_out(spark):
    rng = random.Random(4)
    vocab = {"aa": ["the", "thing", "with", "while"], "bb": ["und", "nicht", "ein", "schön"], "cc": ["el", "los", "para", "señor"]}
    rows = [(i, " ".join(rng.choice(vocab[x]) for _ in range(30)), x) for i in range(240) for x in [rng.choice("abc") * 2]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lm = langid.fit_languages(df.filter("doc_id % 3 != 1").select("text", "lang"))
    got = {r["doc_id"]: r for r in langid.identify_language(df.filter("doc_id % 3 = 1"), lm).collect()}
    assert all(got[i]["best"] == x and 0 <= got[i]["score"] <= 1 for i, _, x in rows if i in got)
    odd = spark.createDataFrame([(1, "zzxq qqzx xxzq " * 10)], "doc_id long, text string")
    assert not langid.identify_language(odd, lm).first()["accepted"]


def test_languages_keep_every_ngram(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_NGRAMS", 20, raising=False)
    monkeypatch.setattr(langid, "MAX_LANGS", 2, raising=False)
    monkeypatch.setattr(langid, "CALIBRATION_ROWS", 100)
    sizes = []
    judge = langid.LanguageModels.judge
    monkeypatch.setattr(langid.LanguageModels, "judge", lambda m, h: sizes.append(len(h)) or judge(m, h))
    rng = random.Random(9)
    # one text is half of the rows
    rows = [(i, "the same text again" if i < 300 else words(rng, 9).translate(str.maketrans("0123456789", x * 10 if i % 7 else f"{x}rstuvwxyz")),
             f"l{x}") for i in range(600) for x in ["abc"[i % 3]]]
    lm = langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert lm.langs == ["la", "lb", "lc"] and 75 <= sizes[0] <= 100
    for lang, m in zip(lm.langs, lm.models):
        keys, counts = np.unique(np.concatenate([langid.ngrams(langid.units(t)) for _, t, x in rows if x == lang]), return_counts=True)
        assert np.array_equal(m.levels[0][1], keys) and np.array_equal(m.levels[0][2], counts)


def test_shards_even_and_gapless(spark, tmp_dir):
    rng = random.Random(6)
    docs = frame(spark, [(i, "x" * int(rng.paretovariate(1.2) * 50)) for i in range(3000)], 7)
    rows = sharding.shard(docs, path=f"{tmp_dir}/map").collect()
    size = Counter()
    places: dict = {}
    for r in rows:
        size[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert len(size) == 16 and all(sorted(p) == list(range(len(p))) for p in places.values())
    # shards that one huge document fills aside, the others are even
    rest = sorted(size.values())[:16 - sum(r["size"] > sum(size.values()) / 20 for r in rows)]
    assert rest[-1] - rest[0] <= 0.002 * rest[-1]
    one = next(r for r in rows if r["doc_id"] == 5)
    t = docs.filter("doc_id = 5").first()["text"]
    assert (one["size"], one["text_crc32"]) == (len(t) + 1, zlib.crc32(t.encode()))
    assert sorted(f.name for f in __import__("pathlib").Path(f"{tmp_dir}/map").iterdir()) == ["version=1", "version=2"]
    m1 = sharding.load_map(spark, f"{tmp_dir}/map", 1)
    assert m1.count() == sharding.SLOTS


# ------------------------------------------------------------ substring, decontamination
def brute_substring(rows, n=13):
    first: dict = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in rows:
        w = t.split()
        gone = {p for k in range(len(w) - n + 1) if first[tuple(w[k:k + n])] < i for p in range(k, k + n)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("bits", [4, 26])
def test_substring_matches_brute_force(spark, monkeypatch, bits):
    """Also with bit sets so small that they let everything through."""
    monkeypatch.setattr(substring, "BITS_LOG2", max(6, bits))
    monkeypatch.setattr(substring, "FEW_LOG2", max(6, bits - 2))
    rng = random.Random(bits)
    passages = [words(rng, rng.randrange(13, 40), 60) for _ in range(6)]
    rows = []
    for i in rng.sample(range(1000), 120):
        t = words(rng, rng.randrange(0, 80), 5 if i % 10 == 0 else 500).split()
        for p in rng.sample(passages, 2):
            w = p.split()
            a = rng.randrange(0, 6)
            t[len(t) // 2:len(t) // 2] = w[a:]
            if rng.random() < 0.3:
                t[rng.randrange(len(t))] = "edit"
        rows.append((i, " ".join(t)))
    rows += [(2000 + i, t) for i, t in rows[:20]]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in substring.substring_dedup(frame(spark, rows, 5)).collect()}
    assert got == brute_substring(rows)


def test_urls(spark):
    u = ["https://a.example.com/en/1", "http://www.example.com/en/x", "http://b.net/es/2", "http://EXAMPLE.com/de/3",
         "http://x.net/en/4?a=1#f", None, "no scheme", "http://com", "http://notcom/", "http://www.example.com.org/en/1"]
    df = spark.createDataFrame([(i, x, "", "h", "r", 1) for i, x in enumerate(u)] + [(0, u[0], "", "h", "r", 1)], PAGES)
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(df).collect())
    assert len(got) == 11
    by = {g[0]: g[1:] for g in got}
    assert by[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert by[1][2:] == ("www.example.com/en/", "allow") and by[2][2:] == ("net/es/", "block")
    assert by[3] == ("example.com", "/de/3", "com/", "allow")
    assert by[4][:3] == ("x.net", "/en/4", None) and by[5][:2] == by[6][:2] == ("", "")
    assert by[7][:3] == ("com", "", None) and by[8][2] is None and by[9][2] is None


def test_mined_rules(spark):
    rows = ([("allow", ["t:a", "t:b"])] * 30 + [("block", ["t:a", "t:c"])] * 20 + [("allow", ["t:a"])] * 5)
    df = spark.createDataFrame(rows, "verdict string, tokens array<string>")
    got = {(tuple(r["tokens"]), r["verdict"]): round(r["confidence"], 3) for r in urls.mine_rules(df, 0.1, 0.6).collect()}
    assert got[("t:c",), "block"] == 1.0 and got[("t:b",), "allow"] == 1.0
    assert got[("t:a",), "allow"] == round(35 / 55, 3) and (("t:a", "t:b"), "allow") not in got


def test_mined_rules_need_more_than_the_fixed_rules_rows(spark):
    names = [f"{a}{b}" for a in "abcde" for b in "vwxyz"]
    u = [f"http://{n}.example.{e}/{p}/{k}" for n in names for k in range(4)
         for e, p in (("net", "es"), ("net", "en"), ("net", "de"), ("org", "en"), ("org", "fr"), ("com", "en"))]
    # a key that goes with blocked pages wherever it occurs is evidence
    u += [f"http://{n}.example.net/fr/?bad=1" for n in names] + ["http://one.example.org/de/?bad=1"]
    df = spark.createDataFrame([(i, x, "", "h", "r", 1) for i, x in enumerate(u)], PAGES)
    got = urls.judge_urls(df).collect()
    assert all(r["verdict"] == "allow" for r in got if r["rule"] is None and r["path"] != "/de/")
    assert [r["verdict"] for r in got if r["page_id"] == len(u) - 1] == ["block"]
    rows = [("block", ["t:n", "t:e"])] * 20 + [(None, ["t:n"])] * 30 + [("allow", ["t:c"])] * 10
    sure = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in urls.mine_rules(
        spark.createDataFrame(rows, "verdict string, tokens array<string>"), 0.1, 0.4).collect()}
    assert sure == {(("t:n",), "block"): 0.4, (("t:e",), "block"): 1.0, (("t:c",), "allow"): 1.0}


def test_chats(spark):
    turns = [("user", "hi"), ("assistant", "hello"), ("user", None), (None, "")]
    rows = [(c, k, *turns[k]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for k in range(n)]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (None, 0, "user", "alone"), (2, 0, "user", "hi")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, k int, h1 long")
    got = {r["conv_id"]: (r["n_turns"], r["rendered"]) for r in chat.format_chats(df).collect()}
    assert sorted(got, key=str) == sorted([2, 5, None], key=str)
    assert got[2][0] == 4 and got[2][1].endswith("<|im_start|>unknown\n<|im_end|>\n")


def test_chats_split_a_long_conversation(spark):
    rng = random.Random(12)
    rows = [(c, k, "user", f"t{k}") for c, n in ((1, 3000), (2, 2990), (3, 3000)) for k in range(n)]
    rows += [(None, k % 3, rng.choice("ab"), f"n{k}") for k in range(1500)] + [(c, 0, None, f"x{c}") for c in range(4, 90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    turns = chat.ordered_turns(df)
    spread = {r["conv_id"]: (r["parts"], r["most"]) for r in turns.groupBy("conv_id", "part").count()
              .groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts"), F.max("count").alias("most")).collect()}
    # no range takes a conversation of a third of the rows whole
    assert spread[1][0] > 1 and spread[1][1] < 2500 and spread[None][0] > 1
    got = {r["conv_id"]: (r["n_turns"], r["rendered"]) for r in chat.format_chats(df).collect()}
    want = {}
    for c in {r[0] for r in rows} - {2, 3}:
        t = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (r[0], r[1] or "", r[2]))
        want[c] = (len(t), "".join(f"<|im_start|>{r or 'unknown'}\n{x}<|im_end|>\n" for _, r, x in t))
    assert got == want


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (3, " -- ")]])
def test_decontamination_without_benchmark_words(spark, items, adaptive):
    # adaptive planning may leave out the scan of the documents
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    empty = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [(1, None), (2, ""), (3, "one two three"), (4, LONG)])
    try:
        rows = decontam.decontaminate(docs, empty).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items"]) for r in rows}
    assert got == {1: (0, 0, 0, []), 2: (0, 0, 0, []), 3: (3, 0, 0, []), 4: (12000, 0, 0, [])}


def test_substring_keeps_words_that_polynomial_hashes_confuse(spark):
    for size in (128, 1024, 4096):
        w = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
        twin = w.translate(str.maketrans("ab", "ba"))
        same = " ".join(f"w{i}" for i in range(12))
        got = {r["doc_id"]: r["n_removed"] for r in substring.substring_dedup(
            frame(spark, [(1, f"{same} {w}"), (2, f"{same} {twin}"), (3, f"{same} {w}")])).collect()}
        assert got == {1: 0, 2: 0, 3: 13}, size


def test_shards_stay_even_with_a_third_of_equal_rows(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(77_777, "the same row")] * 1000 + [(None, None)] * 500
    docs = frame(spark, rows)
    got = sharding.shard(docs, shards=8).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    size, places = Counter(), {}
    for r in got:
        size[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(size) == list(range(8)) and max(size.values()) - min(size.values()) <= 20
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    # slots, bytes and rows by brute force, and the two versions of the map
    assert {r["shard"] for r in got if r["virtual_slot"] == got[0]["virtual_slot"]} == {got[0]["shard"]}
    rows_ = sharding.rows_with_slots(docs).collect()
    load, n = sharding.slot_loads(sharding.rows_with_slots(docs))
    assert Counter(r["virtual_slot"] for r in rows_) == Counter({i: int(x) for i, x in enumerate(n) if x})
    assert int(load.sum()) == sum(r["size"] for r in rows_) == sum(size.values())
    even = sharding.initial_map(8)
    edited = sharding.rebalance(even, load, 8)
    where = {r["virtual_slot"]: r["shard"] for r in got}
    assert all(edited[v] == s for v, s in where.items())
    assert np.ptp(np.bincount(edited, weights=load, minlength=8)) <= np.ptp(np.bincount(even, weights=load, minlength=8))


def brute_url_rules(sets, least, sure):
    """Rules of all itemsets: sets is [(tokens, verdict or None)]."""
    labelled = [(t, v) for t, v in sets if v]
    found = {}
    items = {frozenset(c) for t, _ in labelled for k in range(1, len(t) + 1)
             for c in itertools.combinations(sorted(t), k)}
    for i in items:
        n = sum(i <= t for t, _ in sets)
        for v in ("allow", "block"):
            hits = sum(i <= t and w == v for t, w in labelled)
            if hits >= least * len(labelled) and hits and hits / n >= sure:
                found[i, v] = (hits / n, hits / len(labelled))
    return {k: x for k, x in found.items()
            if not any((k[0] - {t}, k[1]) in found and found[k[0] - {t}, k[1]][0] >= x[0] for t in k[0])}


def test_urls_match_brute_force(spark):
    rng = random.Random(4)
    urls_ = []
    for i in range(120):
        host = rng.choice(["a.com", "b.net", "c.org", "example.com", "d.net"])
        path = "/".join(rng.sample(["es", "fr", "en", "x", "y", "zz"], rng.randrange(1, 4)))
        urls_.append(f"http://{host}/{path}")
    urls_ += ["http://deep.net/es/" + "/".join(f"only{chr(97 + i)}" for i in range(5))] * 6
    pages = spark.createDataFrame([(i, u, "", "h", "r", 1) for i, u in enumerate(urls_)], PAGES)
    host, path = urls.host_and_path(F.col("url"))
    one = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = urls.fixed_rule(F.col("host"), F.col("path"))
    rows = one.select("page_id", urls.url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("t"),
                      name.alias("rule"), verdict.alias("v")).collect()
    rules = brute_url_rules([(frozenset(r["t"]), r["v"]) for r in rows], 0.02, 0.6)
    want = {}
    for r in rows:
        if r["v"]:
            want[r["page_id"]] = (r["rule"], r["v"], None)
            continue
        fit = sorted((-round(c, 9), -round(s, 9), len(i), sorted(i), v) for (i, v), (c, s) in rules.items()
                     if i <= set(r["t"]))
        want[r["page_id"]] = (None, fit[0][4], tuple(fit[0][3])) if fit else (None, "allow", None)
    got = {r["page_id"]: (r["rule"], r["verdict"], tuple(r["mined"]) if r["mined"] else None)
           for r in urls.judge_urls(pages, min_support=0.02).collect()}
    assert got == want and any(x[2] for x in want.values())


def test_urls_with_forty_repeated_tokens(spark):
    deep = "http://x.net/es/" + "/".join(f"w{chr(97 + i // 6)}{chr(97 + i % 6)}" for i in range(40))
    rows = [deep] * 30 + [f"http://h{i}.org/p" for i in range(70)] + ["http://y.org/waa/p"]
    pages = spark.createDataFrame([(i, u, "", "h", "r", 1) for i, u in enumerate(rows)], PAGES)
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages).collect()}
    assert [got[i] for i in (0, 29, 30, 99)] == ["block", "block", "allow", "allow"]
