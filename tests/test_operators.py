"""Unit frames for the traps of SURVEY §7.4 and for operators without a
SQL twin.  Small hand-made inputs; every expectation is computed by hand or by
a brute-force Python loop."""

from __future__ import annotations

import datetime as dt
import math
import os
import random
import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions import arrays as A
from tablekit.functions import text as X
from tablekit.operators import aggs as G
from tablekit.operators import evaluation as EV
from tablekit.operators import series as TS
from tablekit.operators import shape as S
from tablekit.operators import splits as SP
from tablekit.operators.joins import inhibit
from tablekit.sources import sinks as K


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------------ trap 1 / 17
def test_key_dedup_survivor_is_deterministic_and_filter_after(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "b"), (1, 0.0, "a"), (2, None, "x"), (2, 5.0, "y"), (3, float("nan"), "z")],
        "k int, passengers double, tag string")
    for layout in (1, 7):
        d = G.key_dedup(df.repartition(layout), ["k"])
        assert rows(d, "k", "tag") == [(1, "a"), (2, "x"), (3, "z")]
    # NULL in the order column keeps the row (min_by would lose it)
    d = G.key_dedup(df, ["k"], order_by=["passengers"])
    assert rows(d, "k", "tag") == [(1, "a"), (2, "x"), (3, "z")]
    # the filter after the dedup sees the chosen survivor only
    kept = S.positive_filter(G.key_dedup(df, ["k"]), ["passengers"])
    assert rows(kept, "k") == []


def test_dedup_treats_null_keys_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert G.key_dedup(df, ["k"]).count() == 2


# ------------------------------------------------------------------ trap 2 / K7
def test_insert_or_ignore_first_wins_and_null_keys(spark):
    target = spark.createDataFrame([(1, "http://a")], "id long, url string")
    batch = spark.createDataFrame(
        [(10, "http://a", "success"), (11, "https://b", "failed"), (12, "https://b", "success"),
         (13, None, "failed"), (14, None, "failed")],
        "page_id long, url string, status string")
    new = K.insert_or_ignore(target, batch, "url", ["page_id"])
    got = rows(new, "id", "page_id", "status")
    # stored url skipped; first row of b wins; NULL keys never collide
    assert got == [(2, 11, "failed"), (3, 13, "failed"), (4, 14, "failed")]


# ------------------------------------------------------------------ trap 3 / F2
def test_positive_filter_drops_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, None), (4, -1.0)], "k int, x double")
    assert rows(S.positive_filter(df, ["x"]), "k") == [(2,)]
    assert S.dropna_subset(df, ["x"]).count() == 2  # NaN counts as missing


# ------------------------------------------------------------------ trap 5 / P10
def test_coerce_numeric_bad_text_is_null(spark):
    from tablekit.functions.scalars import coerce_numeric
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(coerce_numeric("s")).collect()] == [1.5, None, None]


# ------------------------------------------------------------------ trap 6 / P5
def test_align_features_reports_filled(spark):
    df = spark.createDataFrame([(1, 300.0)], "Type int, Air_temperature_K double")
    out, missing = S.align_features(df, ["Type", "Air temperature [K]"])
    assert missing == ["Air temperature [K]"]
    assert out.columns == ["Type", "Air temperature [K]"]
    assert out.first()[1] == 0
    with pytest.raises(ValueError):
        S.align_features(df, ["Type", "Air temperature [K]"], strict=True)


# ------------------------------------------------------------------ trap 7 / W3
def test_label_encode_map_reused(spark):
    a = spark.createDataFrame([("M",), ("L",), ("H",), (None,)], "t string")
    enc, m = SP.label_encode(a, "t", null_code=-1)
    assert rows(m, "t", "t_code") == [("H", 0), ("L", 1), ("M", 2)]
    assert rows(enc, "t_code") == [(-1,), (0,), (1,), (2,)]
    b = spark.createDataFrame([("M",), ("M",)], "t string")
    assert rows(SP.apply_label_map(b, m, "t", "t_code"), "t_code") == [(2,), (2,)]


# ------------------------------------------------------------------ trap 8 / P7
def test_drift_noise_repeatable_and_excludes(spark):
    df = spark.range(20000).select(F.col("id"), F.lit(0.0).alias("x"), F.lit(1).alias("label"))
    d1 = S.drift_inject(df, "id", sd=0.05, seed=3, exclude=["label"])
    d2 = S.drift_inject(df.repartition(5), "id", sd=0.05, seed=3, exclude=["label"])
    st = d1.agg(F.avg("x"), F.stddev("x"), F.max("label"), F.min("label")).first()
    assert abs(st[0]) < 0.002 and abs(st[1] - 0.05) < 0.002 and st[2] == st[3] == 1
    assert rows(d1, "id", "x") == rows(d2, "id", "x")


# ------------------------------------------------------------------ trap 10 / G8-G10
def test_macro_f1_universe_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "truth int, pred int")
    cm = EV.confusion_matrix(df, "truth", "pred")
    pc = {r["label"]: r for r in EV.per_class(cm).collect()}
    assert pc[2]["f1"] == 0.0 and pc[2]["precision"] == 0.0          # never predicted
    assert math.isclose(pc[1]["f1"], 2 * 1 / (1 + 3))
    macro = EV.macro_f1(cm).first()["macro_f1"]
    assert math.isclose(macro, (2 / 3 + 0.5 + 0.0) / 3)
    classes = spark.createDataFrame([(0,), (1,), (2,), (3,)], "label int")
    full = EV.per_class(cm, classes=classes)
    assert full.count() == 4 and full.filter("label = 3").first()["support"] == 0
    rep = {r["row"]: r for r in EV.classification_report(cm).collect()}
    assert math.isclose(rep["accuracy"]["f1"], 2 / 4) and rep["weighted avg"]["support"] == 4


# ------------------------------------------------------------------ trap 11 / W7
def test_histogram_quantile_edges(spark):
    bounds = [1.0, 2.0, 4.0]
    df = spark.createDataFrame(
        [("a", 2, 4, 4, 4), ("inf", 0, 0, 0, 5), ("empty", 0, 0, 0, 0), ("low", 4, 4, 4, 4)],
        "k string, c0 long, c1 long, c2 long, cinf long")
    q = TS.histogram_quantile_expr(0.5, bounds, [F.col("c0"), F.col("c1"), F.col("c2")],
                                   F.col("cinf"))
    got = {r["k"]: r["q"] for r in df.select("k", q.alias("q")).collect()}
    assert got["a"] == 1.0                # rank 2 reached at the top of bucket 1
    assert got["inf"] == 4.0              # +Inf bucket: largest finite bound
    assert got["empty"] is None           # no observations
    assert got["low"] == 0.5              # first bucket interpolates from 0


# ------------------------------------------------------------------ trap 12 / W6
def test_counter_rate_handles_reset(spark):
    t0 = dt.datetime(2024, 1, 1)
    pts = [(0, 1.0), (60, 4.0), (120, 2.0), (180, 5.0)]  # reset after 4
    df = spark.createDataFrame([("s", t0 + dt.timedelta(seconds=s), v) for s, v in pts],
                               "series string, ts timestamp_ntz, value double")
    r = TS.counter_rate(df, ["series"], "ts", "value", range_s=300, step_s=300)
    got = {row["t"]: row["rate"] for row in r.collect()}
    # frame (t-300, t] at t = 300 s is open on the left: the samples at 60,
    # 120 and 180 s; increases 2 (the reset counts the new value) + 3 = 5
    assert math.isclose(got[t0 + dt.timedelta(seconds=300)], 5 / 300)
    # with a wider range all four samples count: 3 + 2 + 3 = 8
    r2 = TS.counter_rate(df, ["series"], "ts", "value", range_s=600, step_s=300)
    got2 = {row["t"]: row["rate"] for row in r2.collect()}
    assert math.isclose(got2[t0 + dt.timedelta(seconds=300)], 8 / 600)


@pytest.mark.parametrize("range_s,step_s,fanout", [(600, 300, 64), (700, 300, 64), (300, 600, 64), (900, 30, 4),
                                                   (3600, 60, 64)])
def test_counter_rate_equals_a_plain_loop(spark, range_s, step_s, fanout):
    rng = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    rows_ = []
    for name, n, span in (("hot", 400, 6000), ("thin", 12, 9000), ("one", 1, 10)):
        v = 0.0
        for off in sorted(rng.choice([rng.randrange(span), 300 * rng.randrange(span // 300 + 1)]) for _ in range(n)):
            v = rng.choice([v + rng.randrange(5), v + 1, 0.0, 2.0]) if rng.random() < 0.3 else v + 1
            rows_.append((name, t0 + dt.timedelta(seconds=off), v))
    rows_ += [("thin", None, 1.0), ("thin", t0, None)]
    df = spark.createDataFrame(rows_, "series string, ts timestamp_ntz, value double").repartition(5)
    got = {(r["series"], r["t"]): r["rate"] for r in
           TS.counter_rate(df, ["series"], "ts", "value", range_s, step_s, max_fanout=fanout).collect()}
    want = {}
    epoch = dt.datetime(1970, 1, 1)
    for name in ("hot", "thin", "one"):
        mine = sorted((t, v) for s, t, v in rows_ if s == name and t is not None and v is not None)
        k = int((t0 - epoch).total_seconds()) // step_s
        for t in (epoch + dt.timedelta(seconds=(k + i) * step_s) for i in range((9000 + range_s) // step_s + 2)):
            vs = [v for x, v in mine if t - dt.timedelta(seconds=range_s) < x <= t]
            if len(vs) > 1:
                want[name, t] = sum(b if b < a else b - a for a, b in zip(vs, vs[1:])) / range_s
    assert got.keys() == want.keys() and len(want) > 5
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_counter_rate_extrapolation(spark):
    t0 = dt.datetime(2024, 1, 1)
    pts = [(60, 10.0), (120, 20.0), (180, 30.0), (240, 40.0)]
    df = spark.createDataFrame([("s", t0 + dt.timedelta(seconds=s), v) for s, v in pts],
                               "series string, ts timestamp_ntz, value double")
    r = TS.counter_rate(df, ["series"], "ts", "value", range_s=300, step_s=300, extrapolate=True)
    got = {row["t"]: row["rate"] for row in r.collect()}
    # increase 30 over 180 s sampled; 60 s to each edge (< 1.1 x 60 s), zero
    # point 60 s before the first sample: stretched to 300 s -> 10 per minute
    assert math.isclose(got[t0 + dt.timedelta(seconds=300)], 10 / 60)
    # far from the end (gap 360 s >= 1.1 x 60 s): only half an interval added
    r2 = TS.counter_rate(df, ["series"], "ts", "value", range_s=600, step_s=600, extrapolate=True)
    got2 = {row["t"]: row["rate"] for row in r2.collect()}
    assert math.isclose(got2[t0 + dt.timedelta(seconds=600)], 30 * (180 + 60 + 30) / 180 / 600)


def test_sliding_eval_matches_brute_force_across_bucket_edges(spark):
    rnd = random.Random(1)
    t0 = dt.datetime(2024, 1, 1)
    data = [("a" if rnd.random() < 0.7 else "b", t0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400)))
            for _ in range(400)]
    df = spark.createDataFrame(data, "s string, ts timestamp_ntz")
    out = TS.sliding_eval(df, ["s"], "ts", 3600, 7200, {"n": lambda w: F.count("ts").over(w)})
    got = {(r["s"], r["t"]): r["n"] for r in out.filter("n > 0").collect()}
    exp = {}
    for s, ts in data:
        k = math.floor((ts - t0).total_seconds() / 3600)
        for j in range(0, 3):
            t = t0 + dt.timedelta(hours=k + j)
            if t - dt.timedelta(seconds=7200) < ts <= t:
                exp[(s, t)] = exp.get((s, t), 0) + 1
    assert got == exp


@pytest.mark.parametrize("range_s,fanout", [(7200, 64), (5400, 64), (7200, 1)])  # cells, fallbacks
def test_sliding_totals_matches_brute_force(spark, range_s, fanout):
    rnd = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    # samples exactly on grid times test the open left edge of the frame
    data = [("a" if rnd.random() < 0.7 else "b",
             t0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 2 * 86400), 3600 * rnd.randrange(48)])),
             rnd.random() < 0.4)
            for _ in range(400)]
    df = spark.createDataFrame(data, "s string, ts timestamp_ntz, hit boolean")
    sums = {"n": F.lit(1).cast("long"), "hits": F.when(F.col("hit"), 1).otherwise(0).cast("long")}
    out = TS.sliding_totals(df, ["s"], "ts", 3600, range_s, sums, max_fanout=fanout)
    got = {(r["s"], r["t"]): (r["n"], r["hits"]) for r in out.collect()}
    exp = {}
    for s, ts, hit in data:
        k = math.floor((ts - t0).total_seconds() / 3600)
        for j in range(0, 4):
            t = t0 + dt.timedelta(hours=k + j)
            if t - dt.timedelta(seconds=range_s) < ts <= t:
                n, h = exp.get((s, t), (0, 0))
                exp[(s, t)] = (n + 1, h + int(hit))
    assert got == exp


# ------------------------------------------------------------------ trap 14 / 16 / 18
def test_group_rank_layout_free_and_skew_spread(spark):
    hot = [(0, i) for i in range(3000)] + [(g, i) for g in range(1, 4) for i in range(10)]
    df = spark.createDataFrame(hot, "g int, i int")
    a = SP.group_rank(df.repartition(1), ["i"], group=["g"], name="r")
    b = SP.group_rank(df.repartition(7), ["i"], group=["g"], name="r", partitions=16)
    assert rows(a, "g", "i", "r") == rows(b, "g", "i", "r")
    assert all(r == i + 1 for _, i, r in rows(b, "g", "i", "r"))


def test_stratified_split_every_class_in_every_split(spark):
    data = [(c, i) for c, n in (("a", 3), ("b", 4), ("c", 9), ("d", 40)) for i in range(n)]
    df = spark.createDataFrame(data, "label string, id int")
    s1 = SP.stratified_split(df.repartition(3), "label", "id")
    s2 = SP.stratified_split(df.repartition(1), "label", "id")
    assert rows(s1, "label", "id", "split") == rows(s2, "label", "id", "split")
    per = rows(s1.groupBy("label").agg(F.countDistinct("split").alias("n")), "label", "n")
    assert all(n == 3 for _, n in per)


def test_exact_random_split_size(spark):
    df = spark.range(1001)
    s = SP.exact_random_split(df, "id", 0.2)
    assert s.filter("split = 'test'").count() == math.ceil(0.2 * 1001)


def test_weighted_resample_even_classes(spark):
    data = [(0, i) for i in range(900)] + [(1, 900 + i) for i in range(100)]
    df = spark.createDataFrame(data, "label int, id int")
    r = SP.weighted_resample(df, "label", "id", num_samples=4000)
    counts = dict(rows(r.groupBy("label").count(), "label", "count"))
    assert abs(counts[0] - counts[1]) < 400 and sum(counts.values()) == 4000


# ------------------------------------------------------------------ W9 / J4
def test_alert_fires_for_exactly_for_length(spark):
    t0 = dt.datetime(2024, 1, 1)
    cond = spark.createDataFrame([(1, t0 + dt.timedelta(hours=h)) for h in (0, 1, 2, 5, 6)],
                                 "user_id long, t timestamp_ntz")
    a = TS.alert_intervals(cond, ["user_id"], 3600, 7200, "X")
    got = rows(a, "pending_at", "firing_at", "resolved_at")
    assert got == [(t0, t0 + dt.timedelta(hours=2), t0 + dt.timedelta(hours=3))]


def test_inhibit_only_same_instance_and_overlap(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    tgt = spark.createDataFrame([(1, t(1), t(3)), (2, t(1), t(3)), (1, t(5), t(6))],
                                "instance int, start timestamp_ntz, end timestamp_ntz")
    src = spark.createDataFrame([(1, t(2), t(4)), (3, t(0), t(9)), (1, t(6), t(7))],
                                "instance int, start timestamp_ntz, end timestamp_ntz")
    kept = inhibit(tgt, src, ["instance"])
    # (1, 5-6) touches (1, 6-7) only at the edge: not an overlap
    assert rows(kept, "instance", "start") == [(1, t(5)), (2, t(1))]


# ------------------------------------------------------------------ W8 / W4 / W10
def test_inflight_gauge_ends_before_starts(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    df = spark.createDataFrame([("svc", 1, t(0), t(10)), ("svc", 2, t(5), t(20)), ("svc", 3, t(10), t(12))],
                               "svc string, id int, start timestamp_ntz, end timestamp_ntz")
    g = TS.inflight_gauge(df, ["svc"], "start", "end", "id")
    seq = [r["in_flight"] for r in g.orderBy("at_time", "delta", "id").collect()]
    assert max(seq) == 2 and seq[-1] == 0


def test_early_stop(spark):
    h = spark.createDataFrame([("r", e, v) for e, v in enumerate([5.0, 4.0, 4.5, 4.2, 4.1, 3.0])],
                              "run string, epoch int, loss double")
    r = TS.early_stop(h, "run", "epoch", "loss", patience=3).first()
    assert r["stop_epoch"] == 4 and r["best_epoch"] == 1 and r["best_value"] == 4


# ------------------------------------------------------------------ text / links
def test_extract_links_img_and_scripts(spark):
    html = ('<p><img src="a.png"><img src=""><IMG alt=x src=\'b.jpg\'></p>'
            '<script>var s="<img src=\\"no.png\\">";</script><!-- <img src="c.png"> -->'
            '<img data-x=1 src=d.gif?a=1&amp;b=2>')
    df = spark.createDataFrame([(html,)], "html string")
    got = df.select(X.extract_links("html", "img", "src")).first()[0]
    assert got == ["a.png", "b.jpg", "d.gif?a=1&b=2"]


def test_url_list_leading_blank_dropped(spark, tmp_dir):
    from tablekit.sources.files import scan_url_list
    with open(f"{tmp_dir}/urls.csv", "w") as f:
        f.write("https://a.example/x \n ftp://no\n  https://lead.example\nhttp://b.example\n\n")
    got = [r[0] for r in scan_url_list(spark, tmp_dir).collect()]
    assert sorted(got) == ["http://b.example", "https://a.example/x"]


def test_tokenize_matches_python_split(spark):
    texts = ["a  b\tc\n", " x y ", "", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.word_count("t")).collect()]
    assert got == [len(t.split()) for t in texts]


def test_percent_encode_like_quote(spark):
    from urllib.parse import quote
    texts = ["a b/c~*+é?&=", "100% sure"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.percent_encode("t")).collect()] == [quote(t) for t in texts]


def test_entities_offsets(spark):
    t = "Mail ann@x.org on 2024-01-05 about $12.50 and 7 items for New York."
    df = spark.createDataFrame([(t,)], "t string")
    ents = df.select(X.entities("t")).first()[0]
    for e in ents:
        assert t[e["start"]:e["end"]] == e["text"]
    assert [e["label"] for e in ents] == ["EMAIL", "DATE", "MONEY", "NUMBER", "PROPER"]


def test_validate_nonempty_strict_and_loose(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("",), (None,)], "t string")
    v, q = S.validate_nonempty(df, "t", strict=True)
    assert v.count() == 1 and q.count() == 3
    v, q = S.validate_nonempty(df, "t", strict=False)
    assert v.count() == 2 and q.count() == 2


# ------------------------------------------------------------------ arrays / UDF twins
def test_softmax_and_reshape(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0, 0.0],)], "a array<double>")
    r = df.select(A.softmax_confidence("a").alias("s"), A.reshape_array("a", 2, 2).alias("m")).first()
    ex = [math.exp(x - 3) for x in (1, 3, 2, 0)]
    assert r["s"]["predicted"] == 1 and math.isclose(r["s"]["confidence"], 1 / sum(ex))
    assert r["m"] == [[1.0, 3.0], [2.0, 0.0]]


def test_native_speed_equals_udf(spark):
    from tablekit.functions.scalars import duration_hours, safe_ratio
    from tablekit.operators.udfs import speed_udf
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(10.0, t0, t0 + dt.timedelta(hours=2)), (0.0, t0, t0 + dt.timedelta(hours=1)),
                                (5.0, t0, t0), (3.0, t0 + dt.timedelta(hours=1), t0)],
                               "d double, a timestamp_ntz, b timestamp_ntz")
    got = df.select(safe_ratio(F.col("d"), duration_hours("a", "b")).alias("n"),
                    speed_udf("d", "a", "b").alias("u")).collect()
    assert [r["n"] for r in got] == [r["u"] for r in got] == [5.0, None, None, None]


def _plain_histograms(a, cell, block, bins):
    side = len(a)
    k = side // cell
    cells = [[[0.0] * bins for _ in range(k)] for _ in range(k)]
    for y in range(k * cell):
        for x in range(k * cell):
            gx = a[y][x + 1] - a[y][x - 1] if 0 < x < side - 1 else 0.0
            gy = a[y + 1][x] - a[y - 1][x] if 0 < y < side - 1 else 0.0
            o = min(int(math.degrees(math.atan2(gy, gx)) % 180 * bins / 180), bins - 1)
            cells[y // cell][x // cell][o] += math.hypot(gx, gy) / cell ** 2
    out = []
    for i in range(k - block + 1):
        for j in range(k - block + 1):
            v = [h for y in range(i, i + block) for x in range(j, j + block) for h in cells[y][x]]
            v = [min(h / math.sqrt(sum(q * q for q in v) + 1e-10), 0.2) for h in v]
            out += [h / math.sqrt(sum(q * q for q in v) + 1e-10) for h in v]
    return out


def test_feature_udf_equals_plain_loops(spark):
    from tablekit.operators.udfs import feature_udf
    rng = random.Random(3)
    images = [[float(i) for i in range(64)], [rng.gauss(0, 1) for _ in range(64)], [7.0] * 64]
    df = spark.createDataFrame([(x,) for x in [*images, [1.0, 2.0], None, [None] + [1.0] * 63]],
                               "a array<double>").coalesce(1)
    for cell, block in ((2, 2), (4, 1), (3, 2)):
        got = [r[0] for r in df.select(feature_udf(8, 9, cell, block)("a")).collect()]
        assert got[3:] == [None, None, None]
        for x, g in zip(images, got):
            want = _plain_histograms([x[8 * i:8 * i + 8] for i in range(8)], cell, block, 9)
            assert len(g) == len(want) == (8 // cell - block + 1) ** 2 * block ** 2 * 9
            assert max(abs(p - q) for p, q in zip(g, want)) < 1e-9


# ------------------------------------------------------------------ kernel features and the network
def test_rbf_features_approach_the_kernel(spark):
    from tablekit.operators import nets as N
    rng = random.Random(8)
    x = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(40)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)] + [(99, [1.0]), (98, None)], "i int, x array<double>")
    flat = [v for r in x for v in r]
    mean = sum(flat) / len(flat)
    gamma = N.scale_gamma(df.filter("i < 90"), "x")
    assert abs(gamma - 1 / (6 * (sum(v * v for v in flat) / len(flat) - mean ** 2))) < 1e-9
    got = {r["i"]: r["rbf"] for r in N.rbf_features(df, "x", gamma, 6, features=4096).collect()}
    assert got[99] is None and got[98] is None
    for i in range(40):
        for j in range(i + 1):
            exact = math.exp(-gamma * sum((a - b) ** 2 for a, b in zip(x[i], x[j])))
            assert abs(sum(a * b for a, b in zip(got[i], got[j])) - exact) < 0.09


def test_kernel_features_are_made_a_few_rows_at_a_time_and_never_shuffled(spark, monkeypatch):
    from tablekit.operators import nets as N
    from tablekit.plans.ml import q_rbf_kernel
    monkeypatch.setattr(N, "LIFT_VALUES", 64)  # four rows
    x = [[float(i), -0.5 * i] if i % 5 else None for i in range(23)]
    df = spark.createDataFrame(list(enumerate(x)), "i int, x array<double>").coalesce(1)
    got = {r["i"]: r["rbf"] for r in N.rbf_features(df, "x", 0.3, 2, features=16).collect()}
    rng = np.random.default_rng(42)
    w, shift = rng.normal(0.0, math.sqrt(0.6), (2, 16)), rng.uniform(0.0, 2 * math.pi, 16)
    for i, v in enumerate(x):
        assert (got[i] is None) if v is None else np.allclose(got[i], np.cos(np.array(v) @ w + shift) * math.sqrt(1 / 8))
    plan = q_rbf_kernel(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.index("ArrowEvalPython") < plan.index("Join")


def test_net_gradients_equal_finite_differences():
    from tablekit.operators import nets as N
    rng = np.random.default_rng(1)
    net = N.init_net([5, 7, 4, 3], 2)
    net = {k: v + (0.1 * rng.normal(size=v.shape) if not k.startswith(("mean", "var")) else 0) for k, v in net.items()}
    x, y, ids = rng.normal(size=(11, 5)), rng.integers(0, 3, 11), np.arange(11)
    masks = [N.keep_mask(ids, b, i, 3, 9, 0.4) for i, b in enumerate((7, 4))]
    assert {0.0} < set(masks[0].ravel().round(6)) <= {0.0, round(1 / 0.6, 6)}
    _, g, _ = N.loss_and_gradients(net, x, y, masks)
    for k in g:
        for at in [tuple(rng.integers(0, s) for s in net[k].shape) for _ in range(4)]:
            up, down = ({**net, k: net[k].copy()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            slope = (N.loss_and_gradients(up, x, y, masks)[0] - N.loss_and_gradients(down, x, y, masks)[0]) / 2e-5
            assert abs(slope - g[k][at]) < 1e-4 * max(1, abs(slope)), k
    share = N.keep_mask(np.arange(2000), 50, 0, 0, 1, 0.4)
    assert abs((share > 0).mean() - 0.6) < 0.01


def test_net_is_the_same_at_any_partition_count(spark, tmp_dir):
    from tablekit.operators import nets as N
    rng = random.Random(2)
    rows_ = [(i, i % 3, [rng.gauss((i % 3) * 2, 1), rng.gauss(-(i % 3), 1)]) for i in range(300)]
    df = spark.createDataFrame(rows_, "i long, label int, x array<double>")
    runs = [N.train_net(df.repartition(p), [2, 8, 3], "x", "label", "i", epochs=4, batch_rows=40, replicas=4,
                        dropout=0.2, rate=0.05, path=f"{tmp_dir}/{p}") for p in (1, 7)]
    (a, ha), (b, hb) = runs
    assert all(np.array_equal(a[k], b[k]) for k in a) and ha == hb and ha[-1] < ha[0]
    got = N.score_net(df, a, "x").collect()
    want = N.forward(a, np.array([r[2] for r in rows_])).argmax(1)
    assert {r["i"]: r["prediction"] for r in got} == dict(enumerate(want.tolist()))
    odd = spark.createDataFrame([([1.0],), (None,)], "x array<double>")
    assert [r["prediction"] for r in N.score_net(odd, a, "x").collect()] == [None, None]
    assert N.train_net(df.limit(0), [2, 8, 3], "x", "label", "i")[1] == []


def test_a_training_step_is_one_job_of_one_stage(spark):
    from tablekit.operators import nets as N
    sc, rng = spark.sparkContext, random.Random(5)
    df = spark.createDataFrame([(i, i % 2, [rng.random(), rng.random()]) for i in range(200)],
                               "i long, label int, x array<double>")
    jobs = {}
    for epochs in (1, 3):
        sc.setJobGroup(f"net{epochs}", "training")
        N.train_net(df, [2, 4, 2], "x", "label", "i", epochs=epochs, batch_rows=16, replicas=4)
        jobs[epochs] = sc.statusTracker().getJobIdsForGroup(f"net{epochs}")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs[3]) - len(jobs[1]) == 2 * math.ceil(200 / 64)
    last = sc.statusTracker().getJobInfo(max(jobs[3]))
    assert len(last.stageIds) == 1


def test_small_batches_of_a_step_share_a_task_and_give_the_same_net(spark, monkeypatch):
    from tablekit.operators import nets as N
    sc, rng = spark.sparkContext, random.Random(6)
    df = spark.createDataFrame([(i, i % 2, [rng.random(), rng.random()]) for i in range(200)],
                               "i long, label int, x array<double>")
    nets, tasks = [], []
    for products in (1 << 20, 1, 600):  # one task a step, one a batch, three batches a task
        monkeypatch.setattr(N, "TASK_PRODUCTS", products)
        sc.setJobGroup(f"share{products}", "training")
        nets.append(N.train_net(df, [2, 4, 2], "x", "label", "i", epochs=2, batch_rows=12, replicas=5))
        last = sc.statusTracker().getJobInfo(max(sc.statusTracker().getJobIdsForGroup(f"share{products}")))
        tasks.append(sc.statusTracker().getStageInfo(last.stageIds[0]).numTasks)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert tasks == [1, 5, 2]
    for net, history in nets[1:]:
        assert history == nets[0][1] and all(np.array_equal(net[k], nets[0][0][k]) for k in net)


def test_a_fit_takes_partitions_and_copies_by_its_rows(spark, monkeypatch):
    from tablekit.operators import mlops as M
    monkeypatch.setattr(M, "TASK_ROWS", 10)
    monkeypatch.setattr(M, "FIT_ROWS", 40)
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 400, 1, 1)
    spread = M.spread_rows(df, 400)
    assert spread.rdd.getNumPartitions() == max(min(cores, 40), 10) and spread.count() == 400
    assert M.spread_rows(df, 9).rdd.getNumPartitions() == 1
    gathered = M.gather_rows(df.repartition(30), 400, 8)
    assert gathered.rdd.getNumPartitions() == max(2, -(-cores // 8), 10) and gathered.count() == 400
    monkeypatch.setattr(M, "FIT_VALUES", 1000)
    assert [M.fits_at_once(n, 10) for n in (0, 1, 30, 5000)] == [8, 8, 3, 1]


# ------------------------------------------------------------------ rule tables
def test_rules_of_several_ranges_come_from_one_scan(spark):
    from tablekit.plans.series import rule_frames
    plan = rule_frames(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_rule_intervals_equal_a_plain_loop(spark):
    from tablekit.operators.rules import AlertRule, RangeSum, range_sums, routed_alerts, rule_intervals
    rng, t0, step = random.Random(4), dt.datetime(2024, 1, 1), 60
    rows_ = [(k, t0 + dt.timedelta(seconds=rng.choice([rng.randrange(9000), 60 * rng.randrange(150)])),
              rng.choice(["error", "ok"])) for k in "aab" for _ in range(30)]
    rows_ += [("one", t0, "error"), ("none", None, "ok")]
    df = spark.createDataFrame(rows_, "k string, ts timestamp_ntz, kind string").repartition(3)
    bad = F.when(F.col("kind") == "error", 1).otherwise(0).cast("long")
    sums = {"seen": RangeSum(F.lit(1).cast("long"), 300), "bad": RangeSum(bad, 900)}
    rules = [AlertRule("Down", "critical", "x", F.col("seen") == 0, 240), AlertRule("Bad", "warning", "y", F.col("bad") > 1, 120)]
    alerts = rule_intervals(range_sums(df, ["k"], "ts", step, sums), ["k"], step, rules)
    got = {(r["k"], r["alertname"], r["pending_at"], r["firing_at"], r["resolved_at"]) for r in alerts.collect()}
    want = set()
    for k in ("a", "b", "one"):
        mine = [(t, e) for x, t, e in rows_ if x == k]
        first, last = min(t for t, _ in mine), max(t for t, _ in mine)
        at, on = t0, {"Down": [], "Bad": []}
        while at < last + dt.timedelta(seconds=900):
            if at >= first:
                inside = lambda s: [e for t, e in mine if at - dt.timedelta(seconds=s) < t <= at]
                if not inside(300):
                    on["Down"].append(at)
                if inside(900).count("error") > 1:
                    on["Bad"].append(at)
            at += dt.timedelta(seconds=step)
        for name, hold in (("Down", 240), ("Bad", 120)):
            runs = []
            for t in on[name]:
                if runs and t - runs[-1][1] == dt.timedelta(seconds=step):
                    runs[-1][1] = t
                else:
                    runs.append([t, t])
            want |= {(k, name, a, a + dt.timedelta(seconds=hold), b + dt.timedelta(seconds=step)) for a, b in runs
                     if (b - a).total_seconds() >= hold}
    assert got == want and {n for _, n, *_ in want} == {"Down", "Bad"}
    routed = {(r["k"], r["alertname"], r["firing_at"]) for r in routed_alerts(alerts, ["k"], rules).collect()}
    down = [(k, f, e) for k, n, _, f, e in want if n == "Down"]
    assert routed == {(k, n, f) for k, n, _, f, e in want if n == "Down" or not any(
        k == x and f < ee and e > ff for x, ff, ee in down)}


def test_range_sums_shuffle_a_cell_once_and_equal_a_plain_loop(spark):
    from tablekit.operators.rules import RangeSum, range_segments, range_sums
    rng, t0 = random.Random(6), dt.datetime(2024, 1, 1)
    rows_ = [(k, t0 + dt.timedelta(seconds=60 * rng.randrange(400)), rng.choice([None, 0.1, 0.7, 1e12]))
             for k in ("a", None) for _ in range(60)]
    df = spark.createDataFrame(rows_, "k string, ts timestamp_ntz, v double")
    one = F.lit(1).cast("long")
    sums = {"n": RangeSum(one, 300), "far": RangeSum(one, 1800), "v": RangeSum(F.col("v"), 600)}
    got = range_sums(df, ["k"], "ts", 60, sums).collect()
    at = {(r["k"], r["t"]): (r["n"], r["far"], r["v"]) for r in got}
    assert len(at) == len(got)
    for k in ("a", None):
        mine = [(t, v) for x, t, v in rows_ if x == k]
        first, last = min(t for t, _ in mine), max(t for t, _ in mine)
        times = sorted(t for x, t in at if x == k)
        assert times == [first + dt.timedelta(minutes=i) for i in range(int((last - first).total_seconds()) // 60 + 30)]
        for t in times:
            near = lambda s: [v for u, v in mine if t - dt.timedelta(seconds=s) < u <= t]
            n, far, v = at[k, t]
            assert (n, far) == (len(near(300)), len(near(1800)))
            assert v == pytest.approx(math.fsum(x or 0 for x in near(600)), rel=1e-12)
    seg = range_segments(df, ["k"], "ts", 60, sums)
    assert seg.count() < len(got) and seg._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 2


def test_skip_bad_rows_marks_failures(spark):
    from tablekit.operators.udfs import skip_bad_rows
    df = spark.createDataFrame([("1",), ("x",)], "s string")
    out = skip_bad_rows(df, "s", float)
    assert rows(out, "s", "status") == [("1", "success"), ("x", "failed")]
    assert skip_bad_rows(df, "s", float, drop=True).count() == 1


# ------------------------------------------------------------------ schema drift
def test_schema_normalize_case_and_missing(spark):
    df = spark.createDataFrame([(1, "2.5", float("nan"))], "VendorID int, Fare string, Airport_fee double")
    sch = T.StructType([T.StructField("VendorID", T.LongType()), T.StructField("fare", T.DoubleType()),
                        T.StructField("airport_fee", T.DoubleType()), T.StructField("extra", T.StringType())])
    from tablekit.sources.files import schema_normalize
    r = schema_normalize(df, sch).first()
    assert r["VendorID"] == 1 and r["fare"] == 2.5 and r["airport_fee"] is None and r["extra"] is None


def test_rename_ci_merges_variants(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([(None, 2.0), (1.0, None)], "airport_fee double, Airport_fee double")
        out = S.rename_ci(df, ["airport_fee"])
        assert out.columns == ["airport_fee"] and rows(out, "airport_fee") == [(1.0,), (2.0,)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_histogram_buckets_cumulative(spark):
    df = spark.createDataFrame([(0.4,), (1.5,), (40.0,)], "v double")
    h = {r["le"]: r["bucket_count"] for r in G.histogram_buckets(df, "v", [0.5, 1, 2]).collect()}
    assert h == {0.5: 1, 1.0: 1, 2.0: 2, float("inf"): 3}


def test_threshold_rule_and_band(spark):
    from tablekit.functions.scalars import threshold_band
    df = spark.createDataFrame([(69.9,), (70.0,), (85.0,), (None,)], "v double")
    got = [r[0] for r in df.select(threshold_band("v", [(0, "green"), (70, "yellow"), (85, "red")])).collect()]
    assert got == ["green", "yellow", "red", None]


def test_fraction_slice_is_the_positional_band(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)], "k int").repartition(5)
    got = sorted(r["k"] for r in SP.fraction_slice(df, ["k"], 0.7, 0.8).collect())
    assert got == list(range(700, 800))
    got = sorted(r["k"] for r in SP.fraction_slice(df.filter("k < 15"), ["k"], 0.7, 0.8).collect())
    assert got == [10, 11]  # positions floor(10.5) .. floor(12) of 15 rows


def test_islands_match_brute_force(spark):
    rnd = random.Random(5)
    S = 3600 * 1_000_000
    pts = sorted({("hot" if rnd.random() < 0.6 else f"s{rnd.randrange(4)}", rnd.randrange(300))
                  for _ in range(700)})
    df = spark.createDataFrame([(s, k * S) for s, k in pts], "s string, t long")
    exp = []
    for s in sorted({s for s, _ in pts}):
        ks = sorted(k for x, k in pts if x == s)
        run = [ks[0]]
        for k in ks[1:] + [None]:
            if k is not None and k == run[-1] + 1:
                run.append(k)
                continue
            exp.append((s, run[0] * S, run[-1] * S, len(run)))
            if k is not None:
                run = [k]
    for layout in (1, 6):
        got = rows(TS.islands(df.repartition(layout), ["s"], "t", 3600), "s", "start_us", "end_us", "points")
        assert got == sorted(exp)


def test_running_sum_splits_a_hot_first_order_value(spark):
    # 70 % of the rows share one day: the bounds repeat, the ranged path runs
    data = [(0 if i % 10 < 7 else i % 50, i, i % 3) for i in range(3000)]
    df = spark.createDataFrame(data, "day int, id int, v int")
    r = SP.group_running_sum(df.repartition(4), ["day", "id"], "v", name="run", partitions=16)
    exp, acc = {}, 0
    for day, i, v in sorted(data):
        acc += v
        exp[i] = acc
    assert {row["id"]: row["run"] for row in r.collect()} == exp
    g = SP.group_rank(df, ["day", "id"], group=["v"], name="r", partitions=16)
    for v in range(3):
        ids = [i for _, i in sorted((d, i) for d, i, w in data if w == v)]
        got = {row["id"]: row["r"] for row in g.filter(F.col("v") == v).collect()}
        assert [got[i] for i in ids] == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("partitions", [1, 8, 500, 4000])
def test_rank_at_any_partition_count(spark, partitions):
    from tablekit.operators.splits import group_rank
    df = spark.range(3000).select(F.col("id"), (F.col("id") * 7919 % 3000).alias("v"),
                                  F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("g"))
    got = group_rank(df, ["v", "id"], ["g"], partitions=partitions).collect()
    want: dict = {}
    for r in sorted(got, key=lambda r: (r["g"], r["v"], r["id"])):
        want[r["g"]] = want.get(r["g"], 0) + 1
        assert r["rank"] == want[r["g"]]


def test_links_step_over_quotes_and_other_names(spark):
    html = ('<img data-src="lazy.png" src="real.png"><img alt="a>b" src=\'c.png\'><img srcset="x" SRC=d.png>'
            '<image src="no.png"><img/src="e.png">')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(X.extract_links("html", "img", "src")).first()[0] == ["real.png", "c.png", "d.png", "e.png"]


class _Parser(HTMLParser):
    def __init__(self, tag, attr):
        super().__init__()
        self.tag, self.attr, self.found = tag, attr, []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag and dict(attrs).get(self.attr):
            self.found.append(dict(attrs)[self.attr])

    handle_startendtag = handle_starttag


def test_links_equal_an_html_parser(spark):
    rng = random.Random(2)
    attrs = ['src="a>b"', "src='c d'", "src=e/f", 'data-src="g"', "SRC = h", "src", "src=", 'src=""', "alt", "it's",
             'alt="<img src=no>"', "src='i&amp;j&lt;'", "/", "\n"]
    between = ["", " text ", "<p>", "</p>", "<!-- <img src=no> -->", "<script>'<img src=no>'</script>", "a < b ",
               "<style>x<img src=no></style>", "<b class='>'>", "<imgx src=no>", "<!doctype html>", "<!---><!-->"]
    pages = ["".join(rng.choice(between) + "<" + rng.choice(["img", "IMG", "a"]) + " "
                     + " ".join(rng.sample(attrs, rng.randrange(6))) + " >" for _ in range(rng.randrange(5)))
             for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = {r["i"]: r["v"] for r in df.select("i", X.extract_links("h", "img", "src").alias("v")).collect()}
    for i, h in enumerate(pages):
        p = _Parser("img", "src")
        p.feed(h)
        p.close()
        assert got[i] == p.found, h
    odd = ["<img src=\"never closed><img src=b>", "<img src='x", "<!-- open <img src=a>", None, ""]
    df = spark.createDataFrame([(h,) for h in odd], "h string").coalesce(1)
    assert [r[0] for r in df.select(X.extract_links("h", "img", "src")).collect()] == [[], [], [], None, []]


def test_long_tags_and_runs_end_in_time(spark):
    pages = {"<a " + "x" * 1_000_000 + " href=y>": 1, "<a " + "x='1' " * 150_000 + "href=y>": 1,
             '<a "' * 100_000: 0, "<a href='" * 100_000: 0, "<" * 500_000: 0, "<!--" * 200_000: 0}
    df = spark.createDataFrame([(h,) for h in pages], "h string").coalesce(1)
    assert [r[0] for r in df.select(F.size(X.extract_links("h", "a", "href"))).collect()] == list(pages.values())
    texts = {"Ab " * 100_000: 1, "a" * 1_000_000: 0, "a@" + "b." * 200_000: 0, "1 Xy " * 20_000: 20_000}
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    assert [r[0] for r in df.select(F.size(X.entities("t"))).collect()] == list(texts.values())
    assert [r[0] for r in df.select(X.entity_count_by_rule("t", "PROPER")).collect()] == [1, 0, 0, 0]


def test_entities_match_a_plain_scan(spark):
    rules = {"EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
             "MONEY": r"[$€£][0-9]+(?:[.,][0-9]+)?", "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
             "NUMBER": r"[0-9]+(?:\.[0-9]+)?", "PROPER": r"[A-Z][a-z]+(?: [A-Z][a-z]+)+"}
    plain = re.compile("|".join(f"(?P<{k}>{p})" for k, p in rules.items()))
    rng = random.Random(2)
    bits = ["Ab", "c", "@", "x.com", ".", " ", "1", "2024-01-05", "$", "12.5", "New York", "é", "\U0001f389", "-", "a@b.co"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(20))) for _ in range(500)] + ["", None, "1 a " * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", X.entities("t").alias("e")).collect():
        t = texts[r["i"]]
        want = None if t is None else [(m.group(), m.lastgroup, m.start(), m.end()) for m in plain.finditer(t)]
        assert (r["e"] if t is None else [tuple(e) for e in r["e"]]) == want, t


def test_file_name_of_a_url_inside_a_url(spark):
    df = spark.createDataFrame([("https://a.org/web/https://b.org/",), ("http://c.org/x",)], "u string").coalesce(1)
    assert [r[0] for r in df.select(X.url_to_file_name("u", "/d/")).collect()] == [
        "/d/a.org_web_b.org_.html", "/d/c.org_x.html"]


def test_unique_table_reads_few_buckets(spark, tmp_dir):
    from tablekit.sources.keyed import UniqueTable
    t = UniqueTable(spark, f"{tmp_dir}/t", "k", ["at"], buckets=64)
    big = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("at"))
    assert t.insert(big)["rows"] == 3000
    some = big.filter("id < 5").unionByName(spark.createDataFrame(
        [("new", 9), ("new", 8), (None, 1), (None, 1)], "k string, at long"))
    seen = t.stored(some, t.commits())
    # five stored keys: five buckets of 64, named in the scan's partition filter
    assert seen.select(F.input_file_name().alias("f")).distinct().count() <= 6
    scan = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_b#\d+ (IN|INSET)", scan), scan
    c = t.insert(some)
    assert (c["n"], c["rows"], c["last_id"]) == (2, 3, 3003)
    got = t.read()
    assert got.count() == 3003 and got.filter("k is not null").select("k").distinct().count() == 3001
    assert sorted(r["id"] for r in got.select("id").collect()) == list(range(1, 3004))
    assert got.filter("k = 'new'").first()["at"] == 8
    assert t.stored(spark.createDataFrame([("absent",)], "k string"), t.commits()) is None
    assert t.insert(big.limit(0))["rows"] == 0 and t.read().count() == 3003
    one = spark.createDataFrame([("retry", 1)], "k string, at long")
    assert t.insert(one, "w", 7) == t.insert(one, "w", 7) and t.read().count() == 3004


def test_append_log_of_several_writers(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    from tablekit.sources.keyed import AppendLog
    assert AppendLog(spark, f"{tmp_dir}/log").read() is None
    os.makedirs(f"{tmp_dir}/log/commits")  # made by a writer that has not committed yet
    assert AppendLog(spark, f"{tmp_dir}/log").read() is None
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: AppendLog(spark, f"{tmp_dir}/log").append(
            spark.createDataFrame([(i, j) for j in range(i)], "w int, j int")), range(4)))
    assert sorted(c["n"] for c in got) == [1, 2, 3, 4]
    log = AppendLog(spark, f"{tmp_dir}/log")
    spark.createDataFrame([(9, 9)], "w int, j int").write.parquet(f"{tmp_dir}/log/data/_commit=lost")  # never committed
    assert sorted((r["w"], r["j"]) for r in log.read().collect()) == [(i, j) for i in range(4) for j in range(i)]


def test_unique_table_with_two_writers(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    from tablekit.sources.keyed import UniqueTable, put_if_absent
    a = spark.range(0, 60).select(F.col("id").cast("string").alias("k"), F.col("id").alias("at"))
    b = spark.range(30, 90).select(F.col("id").cast("string").alias("k"), F.col("id").alias("at"))
    tables = [UniqueTable(spark, f"{tmp_dir}/t", "k", ["at"], buckets=4) for _ in range(2)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda x: x[0].insert(x[1]), zip(tables, (a, b))))
    got = tables[0].read().collect()
    assert len(got) == 90 and len({r["k"] for r in got}) == 90
    assert sorted(r["id"] for r in got) == list(range(1, 91))
    path = f"{tmp_dir}/claims/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"{i}" * 100), range(8)))
    assert sum(won) == 1 and open(path).read() == f"{won.index(True)}" * 100


def test_broadcast_guard_measures_strings(spark):
    from tablekit.operators.joins import fits_broadcast
    big = spark.range(2000).select("id", F.repeat(F.lit("x"), 200_000).alias("t"))
    assert not fits_broadcast(big) and fits_broadcast(big.select("id"))


def test_windows_keep_rows_without_event_type(spark, tmp_dir):
    from tablekit.plans.streams import q_stream_tumbling
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev = ev.withColumn("event_type", F.when(F.col("event_id") % 10 != 0, F.col("event_type")))
    ev.write.parquet(f"{tmp_dir}/sf/events.parquet")
    assert q_stream_tumbling(spark, f"{tmp_dir}/sf").agg(F.sum("n")).first()[0] == ev.count()


class _Handle:
    """A key's state row and timers, as the stream processors see them."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    exists = lambda self: self.value is not None
    get = lambda self: self.value
    update = lambda self, v: setattr(self, "value", tuple(v))
    clear = lambda self: setattr(self, "value", None)
    registerTimer = lambda self, ms: self.timers.add(ms)
    deleteTimer = lambda self, ms: self.timers.remove(ms)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _cell_feed(proc, times, cell, marks):
    """Closed cells of ``times`` (microseconds) at each watermark, then due timers."""
    h, out, done = _Handle(), [], -1
    proc.init(h)
    for ms in marks:
        now = {}
        for t in times:
            if done < (t // cell + 1) * cell <= ms * 1000:
                now.setdefault(t // cell, []).append(t)
        frames = [pd.DataFrame([(min(x), max(x)) for x in now.values()], columns=["lo_us", "hi_us"])]
        got = list(proc.handleInputRows((7,), iter(frames), _Clock(ms))) if now else []
        for due in sorted(x for x in h.timers if x <= ms):
            h.timers.remove(due)
            got += list(proc.handleExpiredTimer((7,), _Clock(ms), due))
        out += [tuple(None if pd.isna(v) else int(v) for v in r) for p in got for r in p.itertuples(index=False)]
        assert len(h.timers) <= 1
        done = ms * 1000
    return out, h


@pytest.mark.parametrize("seed", range(8))
def test_silences_equal_the_plain_gaps(seed):
    from tablekit.streaming.streams import Silences
    rng = random.Random(seed)
    limit, cell, s = 10_000_000, 2_500_000, 1_000_000
    times = sorted({rng.randrange(400 * s) for _ in range(rng.choice([1, 15, 60]))})
    rng.shuffle(times)
    marks = sorted({rng.randrange(450_000) for _ in range(30)}) + [1_000_000]
    out, h = _cell_feed(Silences(limit, cell), times, cell, marks)
    times.sort()
    closed = [(7, a, b) for a, b in zip(times, times[1:]) if b - a > limit]
    assert [r for r in out if r[2] is not None] == closed
    opened = [r[1] for r in out if r[2] is None]
    assert len(set(opened)) == len(opened) and set(opened) <= {r[1] for r in closed} | {times[-1]}
    assert opened[-1] == times[-1] and h.value[0] == times[-1]  # the row stays


@pytest.mark.parametrize("seed", range(8))
def test_alert_runs_equal_the_plain_runs(seed):
    from tablekit.streaming.streams import AlertRuns
    rng = random.Random(seed)
    step, hold = 10_000_000, 20_000_000
    times = [step * k for k in range(1, 60) if rng.random() < 0.8]
    marks = sorted({rng.randrange(700_000) for _ in range(25)}) + [2_000_000]
    out, h = _cell_feed(AlertRuns(step, hold), times, step, marks)
    runs = []
    for t in times:
        if runs and t <= runs[-1][1] + step:
            runs[-1][1] = t
        else:
            runs.append([t, t])
    assert out == [(7, a, a + hold, b + step) for a, b in runs if b - a >= hold] and h.value is None


def test_silence_stream_with_a_hot_source_and_null_ids(spark, tmp_dir):
    from tablekit.streaming import streams as ST
    t0, rng = dt.datetime(2024, 1, 1), random.Random(1)
    rows_ = [(1, t0 + dt.timedelta(seconds=rng.randrange(50_000))) for _ in range(3000)]
    rows_ += [(k, t0 + dt.timedelta(seconds=rng.randrange(50_000))) for k in (2, 3, None) for _ in range(8)]
    rows_ += [(1, t0 + dt.timedelta(seconds=90_000)), (4, None)]
    rng.shuffle(rows_)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    dirs = {k: f"{tmp_dir}/{k}" for k in ("source", "sink", "checkpoint")}
    ST.stage_files(spark.createDataFrame(rows_, schema), dirs["source"], 3)
    ST.replay(spark, lambda src: ST.stream_no_data(src, "user_id", "ts", 3600, "2 days"), dirs, schema, "append",
              "ts", "user_id", store=ST.STATE_STORE)
    got = {(r["user_id"], r["from_us"], r["to_us"]) for r in ST.read_sink(spark, dirs["sink"]).collect()
           if r["to_us"] is not None and r["to_us"] < ST.SENTINEL_US}
    us = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    want = set()
    for k in (1, 2, 3, None):
        mine = sorted(us(t) for u, t in rows_ if u == k and t is not None)
        want |= {(k, a, b) for a, b in zip(mine, mine[1:]) if b - a > 3600_000_000}
    assert got == want and any(k is None for k, _, _ in want) and any(k == 1 for k, _, _ in want)


class _Map(dict):
    containsKey = dict.__contains__
    getValue = dict.__getitem__
    updateValue = dict.__setitem__
    removeKey = dict.__delitem__


@pytest.mark.parametrize("seed", range(6))
def test_stream_inhibition_matches_all_pairs(seed):
    from tablekit.streaming.streams import Inhibitor
    rng, us = random.Random(seed), 1000
    rows_ = [(rng.choice(["source", "target", "target", "target"]), a * us, (a + rng.choice([3, 9, 40])) * us)
             for a in (rng.randint(1, 400) for _ in range(60))]
    rows_ += [rows_[0], rows_[1]]
    h, proc, out, fed = _Handle(), Inhibitor(16), [], []
    h.getMapState = lambda *a: h.map
    h.map = _Map()
    proc.init(h)
    wm = 0
    while rows_ and wm < 600:
        # a row comes before the watermark passes its start
        now = [r for r in rows_ if r[1] <= (wm + 37) * us]
        rng.shuffle(now)
        feed = pd.DataFrame([(k, a, b, a) for k, a, b in now], columns=["kind", "s_us", "e_us", "p_us"])
        if len(feed):
            out += list(proc.handleInputRows(("1",), iter([feed]), _Clock(wm)))
        for due in sorted(x for x in h.timers if x <= wm):
            h.timers.remove(due)
            out += list(proc.handleExpiredTimer(("1",), _Clock(wm), due))
        fed += now
        rows_ = [r for r in rows_ if r not in now]
        wm += 37
    for due in sorted(h.timers):
        out += list(proc.handleExpiredTimer(("1",), _Clock(10_000), due))
    got = sorted((int(r.firing_us), int(r.resolved_us)) for p in out for r in p.itertuples())
    src = [(a, b) for k, a, b in fed if k == "source"]
    want = sorted((a, b) for k, a, b in fed if k == "target" and not any(x < b and y > a for x, y in src))
    assert got == want and want and not h.map


def test_stream_inhibition_settles_all_due_buckets_in_one_call():
    from tablekit.streaming.streams import Inhibitor
    h, proc, listed = _Handle(), Inhibitor(16), []

    class Map(_Map):
        def keys(self):
            listed.append(len(self))
            return super().keys()
    h.map = Map()
    h.getMapState = lambda *a: h.map
    proc.init(h)
    rows_ = [("target", b * 16_000, b * 16_000 + 4_000, 0) for b in range(300)]
    rows_ += [("source", b * 16_000, b * 16_000 + 1_000, 0) for b in range(0, 300, 3)]
    for part in (rows_[150:], rows_[:150]):
        feed = pd.DataFrame(part, columns=["kind", "s_us", "e_us", "p_us"])
        assert not [len(p) for p in proc.handleInputRows(("5",), iter([feed]), _Clock(0)) if len(p)]
        assert len(h.timers) == 1
    out = []
    for wm in (1600, 100_000):
        (due,) = h.timers
        h.timers.clear()
        out += [int(r.firing_us) // 16_000 for p in proc.handleExpiredTimer(("5",), _Clock(wm), due)
                for r in p.itertuples()]
    assert sorted(out) == [b for b in range(300) if b % 3] and len(listed) == 2 and not h.map and not h.timers


def test_reshape_refuses_other_lengths_and_logits_use_every_value(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1.0] * 5,), (None,)], "a array<double>")
    got = df.select(A.reshape_array("a", 2, 2).alias("m"), A.class_logits("a", 2).alias("l")).collect()
    assert [r["m"] for r in got] == [None, None, None]
    assert [r["l"] for r in got][:2] == [[4.0, 2.0], [3.0, 2.0]]


def test_strict_diff_counts_copies_and_nulls(spark):
    from tablekit.operators.sets import strict_diff
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w")], "k int, v string")
    got = sorted(tuple(r) for r in strict_diff(a, b).collect())
    assert got == [("only_a", 1, "x"), ("only_a", 1, "x"), ("only_a", 3, "z"), ("only_b", 4, "w")]


def test_report_reads_its_rows_once(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "t string, p string")
    rep = EV.classification_report(EV.confusion_matrix(df, "t", "p"))
    assert rep._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    rows = {r["row"]: r for r in rep.collect()}
    assert set(rows) == {"a", "b", "c", "accuracy", "macro avg", "weighted avg"}
    assert math.isclose(rows["accuracy"]["f1"], 2 / 3) and rows["b"]["support"] == 0


def test_net_stops_early_and_keeps_the_net_of_the_least_validation_loss(spark, monkeypatch):
    from tablekit.operators import nets as N
    rng = random.Random(4)
    rows_ = [(i, rng.randrange(3), [rng.gauss(0, 1) for _ in range(4)]) for i in range(160)]  # nothing to learn
    df = spark.createDataFrame(rows_, "i long, label int, x array<double>")
    tr, va = df.filter("i < 80"), df.filter("i >= 80")
    args = ([4, 16, 8, 3], "x", "label", "i")
    kw = dict(batch_rows=20, replicas=2, dropout=0.2, rate=0.05)
    monkeypatch.setattr(N, "VAL_ROWS", 30)
    net, history = N.train_net(tr, *args, epochs=40, val=va, patience=3, **kw)
    losses = [loss for _, loss, _ in history]
    at = losses.index(min(losses))
    assert len(history) == at + 4 < 40  # three epochs without a lesser loss
    x, y = np.array([r[2] for r in rows_[80:]]), np.array([r[1] for r in rows_[80:]])
    z = N.forward(net, x)
    loss = (np.log(np.exp(z).sum(1)) - z[np.arange(80), y]).mean()
    f1 = []
    for c in set(y) | set(z.argmax(1)):
        said, true = z.argmax(1) == c, y == c
        f1.append(2 * (said & true).sum() / (said.sum() + true.sum()))
    assert abs(loss - losses[at]) < 1e-9 and abs(np.mean(f1) - history[at][2]) < 1e-9
    plain, means = N.train_net(tr, *args, epochs=at + 1, **kw)
    assert all(np.array_equal(net[k], plain[k]) for k in net) and means == [m for m, *_ in history[:at + 1]]
    monkeypatch.setattr(N, "TASK_BYTES", 0)  # a large net: broadcast for each job
    again, other = N.train_net(tr, *args, epochs=40, val=va, patience=3, **kw)
    assert other == history and all(np.array_equal(net[k], again[k]) for k in net)
    assert len(N.train_net(tr, *args, epochs=2, val=va.limit(0), **kw)[1]) == 2


def test_identification_report_has_every_step(spark, tmp_dir, monkeypatch):
    from tablekit.operators import nets as N
    from tablekit.plans import ml
    rng = random.Random(8)
    sizes = {-5: 30, 40: 50, 1000: 20, 7: 2}  # the last class is too small
    rows_ = [(label, [rng.gauss(3 * ((k + j) % 3 == 0), 1) for j in range(18)])
             for k, (label, n) in enumerate(sizes.items()) for _ in range(n)]
    spark.createDataFrame([(i, x, label) for i, (label, x) in enumerate(rows_)],
                          "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_dir}/embeddings.parquet")
    trained, train_net = [], N.train_net

    def seen(train, layers, *a, **kw):
        trained.append((layers, kw["epochs"], kw["patience"], {r["split"] for r in kw["val"].select("split").collect()},
                        train_net(train, layers, *a, **{**kw, "epochs": 12})))
        return trained[-1][-1]
    monkeypatch.setattr(N, "train_net", seen)
    got = ml.q_identification_report(spark, tmp_dir).collect()
    (layers, epochs, patience, split, (_, history)), = trained
    assert (layers, epochs, patience, split) == ([18, 512, 256, 128, 3], 50, 10, {"val"})
    assert sorted((r["model"], r["class"], r["support"]) for r in got) == [
        (m, c, n) for m in ("mlp", "svm") for c, n in ((-5.0, 3), (40.0, 5), (1000.0, 2))]
    macro = {m: sum(r["f1"] for r in got if r["model"] == m) / 3 for m in ("svm", "mlp")}
    best = "svm" if macro["svm"] >= macro["mlp"] else "mlp"
    for r in got:
        assert abs(r["macro_f1"] - macro[r["model"]]) < 1e-9 and r["best_model"] == best
        assert [s["row"] for s in r["report"]] == ["accuracy", "macro avg", "weighted avg"]
        assert abs(r["report"][1]["f1"] - r["macro_f1"]) < 1e-9 and r["report"][0]["support"] == 10
        hits = sum(x["recall"] * x["support"] for x in got if x["model"] == r["model"])
        assert abs(r["report"][0]["f1"] - hits / 10) < 1e-9
        p, q = r["precision"], r["recall"]
        assert abs(r["f1"] - (2 * p * q / (p + q) if p + q else 0)) < 1e-9
    assert {r["val_macro_f1"] for r in got if r["model"] == "mlp"} == {max(f1 for *_, f1 in history)}
    assert macro["svm"] > 0.7
