"""Quality classifier: naive Bayes support vectors.

A text is the set of its n-grams: lower-cased words, runs of four bytes, and runs of two and of three equal words (one
n-gram each, whatever the word), hashed into ``dims`` buckets.  Each bucket's
indicator is scaled by its class log-count ratio (add-one smoothed), the scaled row is brought to unit length, and a
linear model with squared hinge loss is fitted on the scaled rows by dual coordinate descent.  The final weights mix the
fitted ones with their mean magnitude, as naive Bayes support vectors do, and a two-parameter logistic curve fitted on a
part of the sample that the coordinate descent has not seen turns margins into probabilities.

Scale: the fit uses at most ``2 * per_class`` labelled rows, whose bucket ids (at most ``dims`` a row) meet in one task.
Scoring is one scan with the model (``dims`` floats) broadcast; nothing is shuffled.

Defined cases: null and empty texts have no n-grams and score by the model's bias alone; repeated rows each get their
row; ties cannot occur; an empty table gives an empty result; without two classes in the sample the model is constant
(score 1.0 if only class 1 was seen or no label at all, else 0.0); other columns are never inputs, and a column
named like an added one is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.fitdata import id_fold, sample_labels
from textlab.llm.textkit import Words, map_batches, mix64, pieces, utf8_buffer

DIMS = 1 << 17
GRAM_BYTES = 4
PER_CLASS = 3000
SCORE_CUT = 0.5


@dataclass(frozen=True)
class NbSvm:
    weights: np.ndarray  # for indicators: the log-count ratio times the fitted weight
    ratio_sq: np.ndarray  # squared log-count ratios, for the row's length
    bias: float
    slope: float
    offset: float


def indicator_rows(data: np.ndarray, offsets: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, ascending, and the texts' offsets (n + 1) into them."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    row_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) >= GRAM_BYTES:
        m = len(data) - GRAM_BYTES + 1
        code = np.zeros(m, dtype=np.uint32)
        for j in range(GRAM_BYTES):
            code = (code << np.uint32(8)) | data[j:j + m].astype(np.uint32)
        inside = row_of_byte[:m] == row_of_byte[GRAM_BYTES - 1:]
        gram = (code * np.uint32(2654435761)) >> np.uint32(8)
        gram_keys = row_of_byte[:m][inside] * dims + (gram[inside] % np.uint32(dims)).astype(np.int64)
    else:
        gram_keys = np.zeros(0, dtype=np.int64)
    word_keys = words.row * dims + (words.hash % np.uint64(dims)).astype(np.int64)
    if len(words.hash):
        for run in (1, 2):
            same = (words.hash[run:] == words.hash[:-run]) & (words.row[run:] == words.row[:-run])
            if run == 2:
                same &= words.hash[1:-1] == words.hash[:-2]
            word_keys = np.concatenate([word_keys, words.row[run:][same] * dims + (dims - run)])
    seen = np.zeros(n * dims, dtype=bool)
    seen[gram_keys] = True
    seen[word_keys] = True
    keys = np.flatnonzero(seen)
    first = np.searchsorted(keys, np.arange(n + 1) * dims)
    return (keys % dims).astype(np.int32), first


def row_blocks(data: np.ndarray, offsets: np.ndarray, dims: int):
    """Pieces of the batch whose indicator table (rows x dims) stays small."""
    for a, b in pieces(offsets):
        for c in range(a, b, 256):
            d = min(c + 256, b)
            lo, hi = offsets[c], offsets[d]
            yield c, d, *indicator_rows(data[lo:hi], offsets[c:d + 1] - lo, dims)


def scaled_values(rows: np.ndarray, first: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Entries of the scaled unit-length rows."""
    norm = np.sqrt(np.add.reduceat(np.append(ratio[rows] ** 2, 0.0), np.minimum(first[:-1], len(rows))) if len(first) > 1 else np.zeros(0))
    norm[np.diff(first) == 0] = 1.0
    return ratio[rows] / np.repeat(np.maximum(norm, 1e-12), np.diff(first))


def dual_coordinate_descent(rows, values, first, y, dims: int, cost: float = 1.0, epochs: int = 60, seed: int = 7,
                            tolerance: float = 1e-3):
    """Weights and bias of min 1/2 |w|^2 + cost_i * sum max(0, 1 - y (w x + b))^2 with balanced class costs.

    The bias is the weight of a constant feature 1.  Rows are visited in a seeded random order each epoch, at most ``epochs``
    times; the descent is done when the greatest projected gradient of an epoch is at most ``tolerance`` times the first epoch's.
    """
    rng = np.random.default_rng(seed)
    n = len(y)
    w, b, alpha = np.zeros(dims), 0.0, np.zeros(n)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    diag = 1.0 / (2.0 * cost * 0.5 / share)
    spans = [(rows[first[i]:first[i + 1]], values[first[i]:first[i + 1]]) for i in range(n)]
    curvature = np.array([1.0 + v @ v for _, v in spans]) + diag
    start = 0.0
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(n):
            at, v = spans[i]
            gradient = y[i] * (w[at] @ v + b) - 1.0 + diag[i] * alpha[i]
            worst = max(worst, abs(gradient) if alpha[i] > 0 else -gradient)
            step = max(alpha[i] - gradient / curvature[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w[at] += step * y[i] * v
                b += step * y[i]
        start = start or worst
        if worst <= tolerance * start:
            break
    return w, b


def logistic_curve(margin: np.ndarray, y01: np.ndarray, prior: float = 0.5, steps: int = 50) -> tuple[float, float]:
    """Newton fit of P(1) = 1 / (1 + exp(-(slope * margin + offset))) with smoothed targets, classes weighted to the share
    ``prior`` of class 1.  A step that does not lower the loss is halved, so large margins cannot make it swing."""
    pos, neg = int(y01.sum()), int((1 - y01).sum())
    target = np.where(y01 == 1, (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0))
    weight = np.where(y01 == 1, prior / max(pos, 1), (1 - prior) / max(neg, 1)) * len(y01)
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([0.0, np.log(prior / (1 - prior))])

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 0.5e-3 * beta[0] ** 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - target)) + np.array([1e-3 * beta[0], 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        now = loss(beta)
        while np.abs(move).max() >= 1e-8 and loss(beta - move) > now:
            move = move / 2
        beta = beta - move
        if np.abs(move).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit_rows(rows: np.ndarray, first: np.ndarray, y01: np.ndarray, dims: int, prior: float = 0.5, beta: float = 0.25) -> NbSvm:
    """The model for indicator rows; every fifth row is kept from the descent to fit the logistic curve."""
    if len(set(y01.tolist())) < 2:
        sure = 30.0 if not len(y01) or y01[0] == 1 else -30.0
        return NbSvm(np.zeros(dims), np.zeros(dims), sure, 1.0, 0.0)
    held = np.arange(len(y01)) % 5 == 4
    if len(set(y01[held].tolist())) < 2:
        held[:] = False
    entry_y = np.repeat(y01, np.diff(first))
    entry_held = np.repeat(held, np.diff(first))
    p = 1.0 + np.bincount(rows[(entry_y == 1) & ~entry_held], minlength=dims)
    q = 1.0 + np.bincount(rows[(entry_y == 0) & ~entry_held], minlength=dims)
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    values = scaled_values(rows, first, ratio)
    fit_at = np.flatnonzero(~held)
    take = np.concatenate([np.arange(first[i], first[i + 1]) for i in fit_at]).astype(np.int64)
    fit_first = np.concatenate([[0], np.cumsum(np.diff(first)[fit_at])])
    w, b = dual_coordinate_descent(rows[take], values[take], fit_first, np.where(y01[fit_at] == 1, 1.0, -1.0), dims)
    w = (1 - beta) * np.abs(w).mean() * np.sign(w) + beta * w if beta < 1 else w
    b = beta * b
    sums = np.add.reduceat(np.append(w[rows] * values, 0.0), np.minimum(first[:-1], len(rows)))
    sums[np.diff(first) == 0] = 0.0
    on = held if held.any() else ~held
    slope, offset = logistic_curve(sums[on] + b, y01[on], prior)
    return NbSvm(w * ratio, ratio ** 2, b, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, exclude=None, label: str = "quality", per_class: int = PER_CLASS,
        dims: int = DIMS, id_col: str = "doc_id", text_col: str = "text") -> NbSvm:
    """Fit on at most ``per_class`` labelled documents of each class; ``exclude`` (a column over ``labels``) marks ids
    that must not be learnt from.  The share of class 1 is counted over all other labels."""
    exclude = F.lit(False) if exclude is None else exclude
    picks = sample_labels(labels, label, exclude, per_class, id_col)
    share = labels.where(~exclude & F.col(label).isin(0, 1)).agg(F.avg(label).alias("p")).first()["p"]
    prior = min(max(0.5 if share is None else float(share), 0.05), 0.95)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.join(F.broadcast(picks), "_id")

    def features(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = utf8_buffer(batch.column("_text"))
        out: list[bytes] = []
        for _, _, rows, first in row_blocks(data, offsets, dims):
            out += [rows[first[i]:first[i + 1]].tobytes() for i in range(len(first) - 1)]
        return [pa.array(out, type=pa.binary())]

    def one_task(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_id", "_rows"], kind="stable")
        sets = [np.frombuffer(x, dtype=np.int32) for x in frame["_rows"]]
        first = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
        rows = np.concatenate(sets) if first[-1] else np.zeros(0, dtype=np.int32)
        m = fit_rows(rows, first, frame["_y"].to_numpy(), dims, prior)
        return pd.DataFrame({"w": [m.weights.tobytes()], "r": [m.ratio_sq.tobytes()], "b": [m.bias], "s": [m.slope], "o": [m.offset]})

    made = (map_batches(texts, features, "_rows binary", keep=["_id", "_y"]).withColumn("_one", F.lit(1))
            .groupBy("_one").applyInPandas(one_task, "w binary, r binary, b double, s double, o double").collect())
    if not made:
        return fit_rows(np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=int), dims)
    r = made[0]
    return NbSvm(np.frombuffer(r["w"]), np.frombuffer(r["r"]), r["b"], r["s"], r["o"])


def score_texts(model: NbSvm, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    dims = len(model.weights)
    out = np.zeros(len(offsets) - 1)
    for a, b, rows, first in row_blocks(data, offsets, dims):
        row = np.repeat(np.arange(b - a), np.diff(first))
        dot = np.bincount(row, weights=model.weights[rows], minlength=b - a)
        norm = np.sqrt(np.bincount(row, weights=model.ratio_sq[rows], minlength=b - a))
        margin = dot / np.maximum(norm, 1e-12) + model.bias
        out[a:b] = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))
    return out


def score(docs: DataFrame, model: NbSvm, text_col: str = "text", keep: list[str] | None = None,
          score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(score_texts(shared.value, *utf8_buffer(batch.column(text_col))))]

    return map_batches(docs, scored, f"{score_col} double", keep=keep)


def op10_quality_nbsvm(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows whose id has crc32 mod 3 = 1 are held out of the fit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, exclude=id_fold(F.col("doc_id"), 3) == 1)
    return (score(docs, model, keep=["doc_id"])
            .select("doc_id", (id_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                    (F.col("score") >= SCORE_CUT).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: NbSvm, cut: float = SCORE_CUT, text_col: str = "text") -> DataFrame:
    """The documents whose score reaches ``cut``, with their own columns."""
    return score(docs, model, text_col, score_col="_quality").where(F.col("_quality") >= cut).select(*docs.columns)
