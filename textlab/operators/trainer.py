"""Distributed full-batch MLP trainer on sparse TF-IDF rows (M1 tier b).

Spark ML's MLP has no dropout, no loss choice and no sample weights; the
reference's network has all three.  This trainer keeps the data distributed
and only the model on the driver:

* the sparse feature rows (indices, values, label, weight) are persisted
  once, in at most one partition per task slot (each partition sends one
  model-sized partial gradient per epoch);
* every epoch the weights are broadcast, ``mapInPandas`` computes the
  partial gradient of each partition with numpy (sparse first layer, ReLU
  hidden layers, inverted dropout, sigmoid output, weighted BCE or focal
  loss), and the partial gradients are summed chunk-wise by a keyed
  ``applyInPandas`` (a group holds one row per partition);
* the driver applies AdamW and starts the next epoch.

The driver holds the model (vocabulary x hidden sizes), never the data.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Gradient chunk (doubles): a reduce group holds partitions x CHUNK values.
CHUNK = 1 << 15


def sparse_rows(tfidf_long: DataFrame, labels: DataFrame, id_col: str, label_col: str,
                max_features: int | None = None, weight_col: str | None = None, vocab: DataFrame | None = None):
    """(vocab_df, rows_df): vocabulary index by df desc, term asc (bounded by
    ``max_features``), or the given ``vocab`` (term, idx); per document the
    index/value arrays in index order, with its label."""
    if vocab is None:
        dfs = tfidf_long.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
        if max_features:
            dfs = dfs.orderBy(F.col("_df").desc(), "term").limit(max_features)
        vocab = dfs.withColumn("idx", (F.row_number().over(Window.orderBy(F.col("_df").desc(), "term")) - 1)
                               .cast("int")).select("term", "idx")
    j = tfidf_long.join(F.broadcast(vocab) if max_features else vocab, "term")
    rows = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_s"))
    rows = rows.select(id_col, F.transform("_s", lambda s: s["idx"]).alias("indices"),
                       F.transform("_s", lambda s: s["weight"]).alias("values"))
    lab = labels.select(id_col, F.col(label_col).cast("double").alias("y"),
                        (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("w"))
    return vocab, lab.join(rows, id_col, "left").select(
        id_col, F.coalesce("indices", F.array().cast("array<int>")).alias("indices"),
        F.coalesce("values", F.array().cast("array<double>")).alias("values"), "y", "w")


def init_params(n_features: int, hidden: Sequence[int], seed: int = 42) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    sizes = [n_features, *hidden, 1]
    params = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        params.append(rng.normal(0.0, np.sqrt(2.0 / a), size=(a, b)))
        params.append(np.zeros(b))
    return params


def _forward_backward(params, indices, values, y, w, dropout, rng, loss, alpha, gamma, n_total):
    """Loss sum and gradient (already divided by n_total) for one batch."""
    n = len(y)
    lens = np.array([len(i) for i in indices], dtype=np.int64)
    rows = np.repeat(np.arange(n), lens)
    idx = np.concatenate(indices).astype(np.int64) if n and lens.sum() else np.zeros(0, np.int64)
    val = np.concatenate(values).astype(np.float64) if n and lens.sum() else np.zeros(0)
    W1, b1 = params[0], params[1]
    z = np.zeros((n, W1.shape[1]))
    if len(idx):
        np.add.at(z, rows, val[:, None] * W1[idx])
    z += b1
    acts, masks, zs = [], [], [z]
    h = z
    for li in range(2, len(params), 2):
        a = np.maximum(h, 0.0)
        m = (rng.random(a.shape) >= dropout) / (1.0 - dropout) if dropout > 0 else np.ones_like(a)
        a = a * m
        acts.append(a)
        masks.append(m)
        h = a @ params[li] + params[li + 1]
        zs.append(h)
    logit = h[:, 0]
    p = 1.0 / (1.0 + np.exp(-logit))
    p = np.clip(p, 1e-12, 1 - 1e-12)
    pt = np.where(y == 1, p, 1 - p)
    s = np.where(y == 1, 1.0, -1.0)
    if loss == "focal":
        at = np.where(y == 1, alpha, 1 - alpha) if alpha is not None else np.ones_like(p)
        per = -at * (1 - pt) ** gamma * np.log(pt)
        dz = s * at * (gamma * pt * (1 - pt) ** gamma * np.log(pt) - (1 - pt) ** (gamma + 1))
    else:
        per = -np.log(pt)
        dz = p - y
    per, dz = per * w, dz * w / n_total
    grads = [None] * len(params)
    d = dz[:, None]
    for li in range(len(params) - 2, 1, -2):
        a = acts[li // 2 - 1]
        grads[li] = a.T @ d
        grads[li + 1] = d.sum(axis=0)
        d = (d @ params[li].T) * masks[li // 2 - 1] * (zs[li // 2 - 1] > 0)
    g1 = np.zeros_like(W1)
    if len(idx):
        np.add.at(g1, idx, val[:, None] * d[rows])
    grads[0], grads[1] = g1, d.sum(axis=0)
    return float(per.sum()), grads


def _flatten(arrs):
    return np.concatenate([a.ravel() for a in arrs])


def _unflatten(vec, like):
    out, o = [], 0
    for a in like:
        out.append(vec[o:o + a.size].reshape(a.shape))
        o += a.size
    return out


def train_mlp(rows: DataFrame, n_features: int, hidden: Sequence[int] = (192,), epochs: int = 70,
              lr: float = 0.02, weight_decay: float = 0.01, dropout: float = 0.0, loss: str = "bce",
              alpha: float | None = 0.25, gamma: float = 2.0, seed: int = 42) -> dict:
    """Full-batch AdamW training; returns {'params': [...], 'losses': [...]}."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    # One partial gradient (model-sized) per partition per epoch: keep at most
    # one partition per task slot (coalesce, no shuffle).
    data = rows.select("indices", "values", "y", "w")
    slots = sc.defaultParallelism
    if data.rdd.getNumPartitions() > slots:
        data = data.coalesce(slots)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    n_total = data.count()
    params = init_params(n_features, hidden, seed)
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    b1, b2, eps = 0.9, 0.999, 1e-8
    losses = []
    size = sum(p.size for p in params)
    n_chunks = (size + CHUNK - 1) // CHUNK
    for epoch in range(epochs):
        bc = sc.broadcast(params)

        def partial(batches, bc=bc, epoch=epoch):
            from pyspark import TaskContext
            pid = TaskContext.get().partitionId()
            rng = np.random.default_rng([seed, epoch, pid])
            total_loss, acc = 0.0, None
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                l, g = _forward_backward(bc.value, list(pdf["indices"]), list(pdf["values"]),
                                         pdf["y"].to_numpy(), pdf["w"].to_numpy(), dropout, rng, loss,
                                         alpha, gamma, n_total)
                total_loss += l
                flat = _flatten(g)
                acc = flat if acc is None else acc + flat
            if acc is None:
                return
            for c in range(n_chunks):
                yield pd.DataFrame({"chunk": [c], "loss": [total_loss if c == 0 else 0.0],
                                    "g": [acc[c * CHUNK:(c + 1) * CHUNK].tobytes()]})

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            tot = np.sum([np.frombuffer(b, dtype=np.float64) for b in pdf["g"]], axis=0)
            return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "loss": [float(pdf["loss"].sum())],
                                 "g": [tot.tobytes()]})

        parts = data.mapInPandas(partial, "chunk int, loss double, g binary")
        summed = parts.groupBy("chunk").applyInPandas(add, "chunk int, loss double, g binary").collect()
        # destroy, not unpersist: the driver would otherwise keep every
        # epoch's model-sized broadcast.
        bc.destroy()
        summed = sorted(summed, key=lambda r: r["chunk"])
        grad = _unflatten(np.concatenate([np.frombuffer(r["g"], dtype=np.float64) for r in summed]), params)
        losses.append(sum(r["loss"] for r in summed) / n_total)
        t = epoch + 1
        for i, g in enumerate(grad):
            m[i] = b1 * m[i] + (1 - b1) * g
            v[i] = b2 * v[i] + (1 - b2) * g * g
            mh, vh = m[i] / (1 - b1 ** t), v[i] / (1 - b2 ** t)
            params[i] = params[i] - lr * (mh / (np.sqrt(vh) + eps) + weight_decay * params[i])
    data.unpersist()
    return {"params": params, "losses": losses}


def predict_mlp(rows: DataFrame, params: list[np.ndarray], id_col: str, threshold: float = 0.5) -> DataFrame:
    """(id, p1, pred) with the trained weights broadcast to every task."""
    bc = rows.sparkSession.sparkContext.broadcast(params)

    def run(batches):
        for pdf in batches:
            ps = bc.value
            rng = np.random.default_rng(0)
            n = len(pdf)
            if n == 0:
                continue
            lens = np.array([len(i) for i in pdf["indices"]], dtype=np.int64)
            rws = np.repeat(np.arange(n), lens)
            z = np.zeros((n, ps[0].shape[1]))
            if lens.sum():
                idx = np.concatenate(list(pdf["indices"])).astype(np.int64)
                val = np.concatenate(list(pdf["values"])).astype(np.float64)
                np.add.at(z, rws, val[:, None] * ps[0][idx])
            h = z + ps[1]
            for li in range(2, len(ps), 2):
                h = np.maximum(h, 0.0) @ ps[li] + ps[li + 1]
            p = 1.0 / (1.0 + np.exp(-h[:, 0]))
            del rng
            yield pd.DataFrame({id_col: pdf[id_col], "p1": p, "pred": (p >= threshold).astype("int32")})

    schema = f"{id_col} {rows.schema[id_col].dataType.simpleString()}, p1 double, pred int"
    return rows.select(id_col, "indices", "values").mapInPandas(run, schema)
