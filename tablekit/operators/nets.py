"""Kernel features and a small network trained on Spark (M5, M6).

Rows stay distributed.  What reaches the driver is bounded by the model: the
kernel's random directions, or one gradient per mini-batch of a step, of which
a step takes ``replicas``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- M5
_ARRAY = T.ArrayType(T.DoubleType())
#: Feature values that a task's Python makes at a time (8 MB).
LIFT_VALUES = 1 << 20


def scale_gamma(train: DataFrame, col: str) -> float:
    """1 / (length * variance of all values): one aggregate."""
    part = lambda f: F.aggregate(F.transform(col, f), F.lit(0.0), lambda a, x: a + x)
    r = train.agg(F.max(F.size(col)).alias("d"), F.sum(F.size(col)).alias("n"),
                  F.sum(part(lambda x: x.cast("double"))).alias("s"),
                  F.sum(part(lambda x: x.cast("double") * x)).alias("q")).first()
    var = r["q"] / r["n"] - (r["s"] / r["n"]) ** 2
    return 1.0 / (r["d"] * var) if var > 0 else 1.0


def rbf_features(df: DataFrame, col: str, gamma: float, size: int, features: int = 512, seed: int = 42,
                 out: str = "rbf") -> DataFrame:
    """Random Fourier features of an array column of length ``size``: the dot
    product of two rows' features approaches exp(-gamma |x - y|^2), with an
    error of about 1 / sqrt(features).  Linear models on them are kernel
    models, at the cost of a linear one.  Arrays of another length give NULL.
    The directions depend on ``seed`` alone.  Python holds ``LIFT_VALUES``
    feature values at a time, however many rows an Arrow batch has."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), (size, features))
    shift = rng.uniform(0.0, 2 * math.pi, features)
    shared = df.sparkSession.sparkContext.broadcast((w, shift))

    rows = max(1, LIFT_VALUES // features)

    @F.pandas_udf(_ARRAY)
    def lifted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, shift = shared.value
        for batch in batches:
            for at in range(0, len(batch), rows):
                arrays = batch.iloc[at:at + rows]
                ok = [a is not None and len(a) == len(w) for a in arrays]
                z = iter(())
                if any(ok):
                    x = np.stack([np.asarray(a, np.float64) for a, good in zip(arrays, ok) if good])
                    z = iter(np.cos(x @ w + shift) * math.sqrt(2.0 / len(shift)))
                yield pd.Series([next(z) if good else None for good in ok], dtype=object)
    return df.withColumn(out, lifted(col))


# ---------------------------------------------------------------- M6
BN_EPS, BN_KEEP = 1e-5, 0.9
#: Products of a row's value and a weight that a training task takes, about:
#: below it a task's start costs more than its mini-batches do.
TASK_PRODUCTS = 5 << 19
#: Bytes of a net that travel with each task; a larger net is broadcast.
TASK_BYTES = 1 << 19
#: Rows of a validation task, about.
VAL_ROWS = 1 << 12


def init_net(layers: list[int], seed: int) -> dict[str, np.ndarray]:
    """Weights, normalisation scales and shifts, and their running statistics."""
    rng = np.random.default_rng(seed)
    net = {}
    for i, (a, b) in enumerate(zip(layers, layers[1:])):
        net[f"w{i}"] = rng.normal(0, math.sqrt(2.0 / a), (a, b))
        net[f"b{i}"] = np.zeros(b)
        if i < len(layers) - 2:
            net[f"scale{i}"], net[f"shift{i}"] = np.ones(b), np.zeros(b)
            net[f"mean{i}"], net[f"var{i}"] = np.zeros(b), np.ones(b)
    return net


def keep_mask(ids: np.ndarray, units: int, layer: int, step: int, seed: int, rate: float) -> np.ndarray:
    """Dropout mask from hashes of (row, unit, layer, step, seed), already
    scaled by what it keeps: the same wherever and whenever a row is read."""
    x = (ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
         + np.arange(units, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
         + np.uint64((layer * 1_000_003 + step * 8_191 + seed * 131) & (1 << 63) - 1))
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)) / float(1 << 53) >= rate) / (1.0 - rate)


def loss_and_gradients(net: dict, x: np.ndarray, y: np.ndarray, masks: list[np.ndarray]):
    """Sum of cross-entropies of one mini-batch, its gradients (sums), and the
    batch's (mean, var) per hidden layer.  Linear, batch normalisation over
    the mini-batch, ReLU, dropout; the last layer is linear."""
    hidden = len(masks)
    h, memory, stats = x, [], []
    for i in range(hidden):
        a = h @ net[f"w{i}"] + net[f"b{i}"]
        mean, var = a.mean(0), a.var(0)
        unit = (a - mean) / np.sqrt(var + BN_EPS)
        n = unit * net[f"scale{i}"] + net[f"shift{i}"]
        memory.append((h, unit, var, n))
        stats.append((mean, var))
        h = np.maximum(n, 0) * masks[i]
    z = h @ net[f"w{hidden}"] + net[f"b{hidden}"]
    z = z - z.max(1, keepdims=True)
    logsum = np.log(np.exp(z).sum(1, keepdims=True))
    loss = float((logsum[:, 0] - z[np.arange(len(y)), y]).sum())
    d = np.exp(z - logsum)
    d[np.arange(len(y)), y] -= 1
    g = {f"w{hidden}": h.T @ d, f"b{hidden}": d.sum(0)}
    d = d @ net[f"w{hidden}"].T
    for i in reversed(range(hidden)):
        below, unit, var, n = memory[i]
        d = d * masks[i] * (n > 0)
        g[f"scale{i}"], g[f"shift{i}"] = (d * unit).sum(0), d.sum(0)
        d = d * net[f"scale{i}"]
        d = (d - d.mean(0) - unit * (d * unit).mean(0)) / np.sqrt(var + BN_EPS)
        g[f"w{i}"], g[f"b{i}"] = below.T @ d, d.sum(0)
        d = d @ net[f"w{i}"].T
    return loss, g, stats


def forward(net: dict, x: np.ndarray) -> np.ndarray:
    """Class scores with the running statistics and without dropout."""
    i = 0
    while f"scale{i}" in net:
        a = x @ net[f"w{i}"] + net[f"b{i}"]
        x = np.maximum((a - net[f"mean{i}"]) / np.sqrt(net[f"var{i}"] + BN_EPS) * net[f"scale{i}"]
                       + net[f"shift{i}"], 0)
        i += 1
    return x @ net[f"w{i}"] + net[f"b{i}"]


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row with the bytes of a mini-batch: ids, labels, vectors by id."""
    pdf = pdf.sort_values("id", kind="stable")
    return pd.DataFrame({"batch": [int(pdf["batch"].iat[0])], "n": [len(pdf)],
                         "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                         "y": [pdf["y"].to_numpy(np.int64).tobytes()],
                         "x": [np.stack(list(pdf["x"])).astype(np.float64).tobytes()]})


def _unpacked(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors of a packed mini-batch."""
    ids, y, x = (np.frombuffer(r[k], t) for k, t in (("ids", np.int64), ("y", np.int64), ("x", np.float64)))
    return ids, y, x.reshape(r["n"], -1)


def _job(batches, net: dict, task, partitions=None) -> list:
    """``task(net, rows)`` of these partitions of packed mini-batches.  A
    large net is broadcast for this job alone, so none pile up."""
    sc = batches.context
    if sum(v.nbytes for v in net.values()) <= TASK_BYTES:
        return sc.runJob(batches, lambda rows: task(net, rows), partitions)
    shared = sc.broadcast(net)
    try:
        return sc.runJob(batches, lambda rows: task(shared.value, rows), partitions)
    finally:
        shared.destroy()


def _batch_gradients(hidden: list[int], names: list[str], tick: int, seed: int, dropout: float):
    """Task of a step: (batch, row count, loss, gradients, statistics) of each
    mini-batch of its partition, one after another."""
    def run(net, rows):
        out = []
        for r in rows:
            ids, y, x = _unpacked(r)
            masks = [keep_mask(ids, b, i, tick, seed, dropout) for i, b in enumerate(hidden)]
            loss, g, stats = loss_and_gradients(net, x, y, masks)
            out.append((r["batch"], r["n"], loss, np.concatenate([g[k].ravel() for k in names]),
                        np.concatenate([v for pair in stats for v in pair]) if stats else np.zeros(0)))
        return out
    return run


def _batch_scores(classes: int):
    """Task of a validation: (batch, row count, loss, counts) of each batch of
    its partition; counts by class of true, predicted and rightly predicted
    rows."""
    def run(net, rows):
        out = []
        for r in rows:
            _, y, x = _unpacked(r)
            z = forward(net, x)
            z = z - z.max(1, keepdims=True)
            loss = float((np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).sum())
            best = z.argmax(1)
            out.append((r["batch"], r["n"], loss,
                        np.stack([np.bincount(v, minlength=classes) for v in (y, best, y[y == best])])))
        return out
    return run


def _validate(batches, net: dict, classes: int) -> tuple[float, float]:
    """Mean loss, and macro F1 over the classes seen in truth or prediction."""
    parts = sorted(_job(batches, net, _batch_scores(classes)), key=lambda p: p[0])
    true, said, right = np.sum([counts for *_, counts in parts], axis=0)
    seen = true + said > 0
    return (sum(loss for _, _, loss, _ in parts) / sum(n for _, n, *_ in parts),
            float((2 * right[seen] / (true + said)[seen]).mean()))


def _adam_step(net: dict, moment: dict, t: int, parts: list[tuple], names: list[str], hidden: list[int],
               rate: float, decay: float) -> dict:
    """The net after step ``t`` on the batches ``parts``, in their order;
    ``moment`` is brought up to date."""
    count = sum(n for _, n, *_ in parts)
    flat = np.sum([g for *_, g, _ in parts], axis=0) / count
    net, at = dict(net), 0
    for k in names:
        size = net[k].size
        g = flat[at:at + size].reshape(net[k].shape) + decay * net[k]
        at += size
        m, v = moment[k]
        moment[k] = m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        net[k] = net[k] - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    seen = np.sum([stats * n for _, n, _, _, stats in parts], axis=0) / count
    at = 0
    for i, b in enumerate(hidden):
        for k in (f"mean{i}", f"var{i}"):
            net[k] = BN_KEEP * net[k] + (1 - BN_KEEP) * seen[at:at + b]
            at += b
    return net


def train_net(train: DataFrame, layers: list[int], col: str, label: str, key: str, epochs: int = 20,
              batch_rows: int = 256, replicas: int = 8, rate: float = 0.01, dropout: float = 0.4,
              decay: float = 1e-4, seed: int = 42, path: str | None = None, val: DataFrame | None = None,
              patience: int = 10) -> tuple[dict, list]:
    """Train by Adam on mini-batches -> (net, mean loss of each epoch).

    With rows ``val`` of the same columns, training ends after ``patience``
    epochs without a lesser mean loss on them, the net of the least one is
    returned, and the history has (training loss, validation loss, validation
    macro F1) of each epoch.  A validation is a job of one stage, too.

    Rows are dealt into mini-batches of about ``batch_rows`` by a hash of
    ``key``, and batches into steps of ``replicas``.  Mini-batches are packed
    into a checkpoint, once, and a step is a job of one stage on its own
    partitions: nothing is shuffled, sorted or planned in a step.  A partition
    holds as many of a step's batches as make ``TASK_PRODUCTS``, one at least:
    those of a small net share a task, those of a large one run in parallel.
    Each batch is normalised by its own statistics, and gradients are added in
    batch order.  Batches are sorted by key and masks come from hashes, so the
    same net comes out at any partition count.  The batches lie in the
    session's checkpoint folder, and in the executors' memory while the net is
    trained; ``path`` has no effect.
    """
    n = train.count()
    if not n:
        return init_net(layers, seed), []
    steps = max(1, math.ceil(n / (batch_rows * replicas)))

    def dealt(df: DataFrame, parts: int, tasks: int, part) -> RDD:
        """Rows in ``parts`` packed batches, held in ``tasks`` partitions."""
        from tablekit.operators.mlops import training_frame
        rows = (df.select(F.xxhash64(key).alias("id"), F.col(label).cast("int").alias("y"),
                          F.col(col).cast("array<double>").alias("x"))
                .withColumn("batch", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts)).cast("int")))
        packed = rows.groupBy("batch").applyInPandas(_packed, "batch int, n int, ids binary, y binary, x binary")
        return training_frame(packed.repartitionById(tasks, part)).rdd.persist(StorageLevel.MEMORY_AND_DISK)
    products = batch_rows * sum(a * b for a, b in zip(layers, layers[1:]))
    shared = max(1, min(replicas, TASK_PRODUCTS // products))  # batches of a partition
    tasks = math.ceil(replicas / shared)
    part = F.expr(f"batch div {replicas} * {tasks} + batch % {replicas} div {shared}").cast("int")
    batches = dealt(train, steps * replicas, steps * tasks, part)
    held = None
    if val is not None and (n_val := val.count()):
        parts = math.ceil(n_val / VAL_ROWS)
        held = dealt(val, parts, parts, F.col("batch"))
    net = init_net(layers, seed)
    hidden = layers[1:-1]
    names = [k for k in net if not k.startswith(("mean", "var"))]
    moment = {k: (np.zeros_like(net[k]), np.zeros_like(net[k])) for k in names}
    history, t = [], 0
    least, kept, stale = math.inf, None, 0
    for epoch in range(epochs):
        total = 0.0
        for step in range(steps):
            task = _batch_gradients(hidden, names, epoch * steps + step, seed, dropout)
            # at most ``replicas`` results of the net's size
            parts = _job(batches, net, task, range(step * tasks, (step + 1) * tasks))
            parts.sort(key=lambda p: p[0])
            if not parts:
                continue
            t += 1
            total += sum(loss for _, _, loss, *_ in parts)
            net = _adam_step(net, moment, t, parts, names, hidden, rate, decay)
        if held is None:
            history.append(total / n)
            continue
        loss, f1 = _validate(held, net, layers[-1])
        history.append((total / n, loss, f1))
        stale += 1
        if loss < least:
            least, kept, stale = loss, net, 0
        elif stale >= patience:
            break
    batches.unpersist()
    if held is not None:
        held.unpersist()
    return kept or net, history


def score_net(df: DataFrame, net: dict, col: str, out: str = "prediction") -> DataFrame:
    """Add the most likely class; arrays of another length give NULL."""
    shared = df.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf(T.IntegerType())
    def best(arrays: pd.Series) -> pd.Series:
        size = len(shared.value["w0"])
        ok = np.array([a is not None and len(a) == size for a in arrays], bool)
        got = pd.Series(np.zeros(len(arrays)), dtype="Int32").mask(~ok)
        if ok.any():
            x = np.stack([np.asarray(a, np.float64) for a in arrays[ok]])
            got[ok] = forward(shared.value, x).argmax(1)
        return got
    return df.withColumn(out, best(col))
