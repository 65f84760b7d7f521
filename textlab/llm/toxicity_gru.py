"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A text's words are read in windows of ``WINDOW`` words that overlap by half; a run of over ``LONGEST`` bytes without a blank is
cut at character bounds into pieces that count as words, so texts without blanks have windows too.  A word's input is its word vector (a
hashed table) beside the mean of the vectors of its character runs (``GRAM`` bytes, the word's edges included, also
hashed), so an unseen word is known by its parts.  Two gated recurrent layers read a window in both directions; attention
weighs their states, and a linear layer scores the weighted mean.  A text's margin is that of its most toxic window,
turned into a probability by a logistic curve.

Training (numpy, backpropagation through time, Adam) knows labels of whole texts only.  One component of each table
starts as the log ratio of how often toxic and other texts it learns from hold the bucket.  Then rounds follow: the network
scores all windows of the sample (in the first round the starting ratios do); each toxic text gives its best window as a positive case, the other texts their four best
and as many random windows as negative cases.

Scale: the sample has at most ``2 * per_class`` texts and is fitted in one task; scoring is one scan with the model
(under 3 MB) broadcast, in pieces of about a megabyte, and shuffles nothing.

Defined cases: null and empty texts have no window and score as a margin of ``EMPTY_MARGIN``; repeated rows each get
their row; ties between windows do not matter for a maximum; an empty table gives an empty result; without both classes
in the sample every score is 0 (or 1 if only toxic ones are labelled); other columns are never inputs, one named like an
added column is replaced by it.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.fitdata import id_fold, sample_labels
from textlab.llm.quality_nbsvm import logistic_curve
from textlab.llm.textkit import Words, map_batches, mix64, pieces, span_hash, utf8_buffer

WINDOW = 24
STRIDE = 12
LONGEST = 16
GRAM = 6
BUCKETS = 1 << 16
WORD_DIMS = 4
GRAM_DIMS = 6
HIDDEN = 12
PER_CLASS = 1500
SCORE_CUT = 0.3
EMPTY_MARGIN = -8.0
_BLOCK = 8192


@dataclass
class ToxicNet:
    """``parts``: arrays by name; ``slope`` and ``offset``: the logistic curve; ``constant``: score if nothing was learnt."""

    parts: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, slope=self.slope, offset=self.offset, constant=np.nan if self.constant is None else self.constant, **self.parts)
        return out.getvalue()

    @staticmethod
    def unpacked(raw: bytes) -> ToxicNet:
        held = dict(np.load(io.BytesIO(raw)))
        constant = float(held.pop("constant"))
        return ToxicNet(slope=float(held.pop("slope")), offset=float(held.pop("offset")),
                        constant=None if np.isnan(constant) else constant, parts=held)


class Inputs:
    """Distinct words of some texts: hashed word and character-run buckets, and each word position's distinct word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        begin, end, value = words.start, words.end, words.hash
        if len(begin) and (end - begin).max() > LONGEST:
            begin, end = cut_runs(data, begin, end)
            value = span_hash(words.prefix, begin, end)
        self.first = np.searchsorted(begin, offsets)
        _, at, self.word_of = np.unique(value, return_index=True, return_inverse=True)
        self.word_bucket = (value[at] % np.uint64(BUCKETS)).astype(np.int64)
        start, length = begin[at], end[at] - begin[at]
        # A word's bytes with an edge mark on both sides, cut into runs of GRAM bytes (one run if it is short).
        runs = np.maximum(length + 2 - GRAM + 1, 1)
        self.gram_first = np.concatenate([[0], np.cumsum(runs)])
        owner = np.repeat(np.arange(len(at)), runs)
        place = np.arange(self.gram_first[-1]) - self.gram_first[owner] - 1
        value = np.zeros(len(owner), dtype=np.uint64)
        for j in range(GRAM):
            inside = (place + j >= 0) & (place + j < length[owner])
            byte = data[np.where(inside, start[owner] + place + j, 0)].astype(np.uint64) if len(data) else value
            byte = np.where((byte >= 65) & (byte <= 90), byte + np.uint64(32), byte)
            value = value * np.uint64(257) + np.where(inside, byte + np.uint64(1), np.uint64(0))
        self.gram_bucket = (mix64(value) % np.uint64(BUCKETS)).astype(np.int64)

    def runs_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character-run buckets of distinct ``words``, and the words' offsets (n + 1) into them."""
        counts = np.diff(self.gram_first)[words]
        first = np.concatenate([[0], np.cumsum(counts)])
        return self.gram_bucket[np.repeat(self.gram_first[words] - first[:-1], counts) + np.arange(first[-1])], first

    def vectors(self, parts: dict[str, np.ndarray], words: np.ndarray | None = None) -> np.ndarray:
        """Input vector of each distinct word, or of some."""
        bucket, first = (self.gram_bucket, self.gram_first) if words is None else self.runs_of(words)
        own = self.word_bucket if words is None else self.word_bucket[words]
        if not len(own):
            return np.zeros((0, WORD_DIMS + GRAM_DIMS), dtype=np.float32)
        sums = np.add.reduceat(parts["grams"][bucket], first[:-1], axis=0)
        return np.concatenate([parts["words"][own], sums / np.diff(first)[:, None].astype(np.float32)], axis=1)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, text) of all windows."""
        counts = np.diff(self.first)
        n = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
        text = np.repeat(np.arange(len(counts)), n)
        number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        return self.first[text] + number * STRIDE, text

    def tokens(self, start: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct word of each place of the windows (n x WINDOW), and which places hold a word."""
        at = start[:, None] + np.arange(WINDOW)[None, :]
        mask = at < self.first[text + 1][:, None]
        return self.word_of[np.where(mask, at, start[:, None])], mask


def cut_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans cut into ones of about ``LONGEST`` bytes, each cut moved back to the beginning of its character."""
    parts = -(-(end - start) // LONGEST)
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    begins = np.repeat(start, parts) + number * LONGEST
    for _ in range(3):
        begins -= (number > 0) & (data[begins] & 0xC0 == 0x80)
    last = np.append(number[1:] == 0, True)
    return begins, np.where(last, np.repeat(end, parts), np.append(begins[1:], 0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _read(gates: np.ndarray, u: np.ndarray, tokens: np.ndarray, mask: np.ndarray, backward: bool, keep: list | None = None) -> np.ndarray:
    """States (WINDOW x n x HIDDEN) of one direction; ``gates``: the input's share of each distinct word's gates."""
    n = len(tokens)
    states = np.zeros((WINDOW, n, HIDDEN), dtype=gates.dtype)
    h = np.zeros((n, HIDDEN), dtype=gates.dtype)
    for t in range(WINDOW - 1, -1, -1) if backward else range(WINDOW):
        gx, gh = gates[tokens[:, t]], h @ u
        rz = _sigmoid(gx[:, :2 * HIDDEN] + gh[:, :2 * HIDDEN])
        r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
        new = np.tanh(gx[:, 2 * HIDDEN:] + r * gh[:, 2 * HIDDEN:])
        after = np.where(mask[:, t, None], new + z * (h - new), h)
        if keep is not None:
            keep.append((t, h, r, z, new, gh[:, 2 * HIDDEN:]))
        states[t] = h = after
    return states


def _pool(parts: dict[str, np.ndarray], states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Margins, attention weights and pooled states."""
    e = np.where(mask.T, states @ parts["attend"], -1e9)
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", a, states)
    return pooled @ parts["out"] + parts["bias"][0], a, pooled


def window_margins(parts: dict[str, np.ndarray], inputs: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(margin, first word, text) of all windows."""
    x = inputs.vectors(parts)
    forward, backward = (x @ parts[f"w{d}"] + parts[f"b{d}"] for d in "fb")
    start, text = inputs.windows()
    out = np.zeros(len(start), dtype=np.float32)
    for a in range(0, len(start), _BLOCK):
        tokens, mask = inputs.tokens(start[a:a + _BLOCK], text[a:a + _BLOCK])
        states = np.concatenate([_read(forward, parts["uf"], tokens, mask, False), _read(backward, parts["ub"], tokens, mask, True)], axis=2)
        out[a:a + _BLOCK] = _pool(parts, states, mask)[0]
    return out, start, text


def text_margins(parts: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.full(len(offsets) - 1, EMPTY_MARGIN)
    for a, b in pieces(offsets):
        inputs = Inputs(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        margin, _, text = window_margins(parts, inputs)
        best = np.full(b - a, -np.inf)
        np.maximum.at(best, text, margin)
        out[a:b] = np.where(np.isfinite(best), best, EMPTY_MARGIN)
    return out


def loss_and_gradients(parts: dict[str, np.ndarray], inputs: Inputs, start: np.ndarray, text: np.ndarray, y: np.ndarray,
                       weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted mean logistic loss over windows, and its gradients by backpropagation through time."""
    tokens, mask = inputs.tokens(start, text)
    used, local = np.unique(tokens, return_inverse=True)
    local = local.reshape(tokens.shape)
    x = inputs.vectors(parts, used)
    steps: dict[str, list] = {"f": [], "b": []}
    states = np.concatenate([_read(x @ parts[f"w{d}"] + parts[f"b{d}"], parts[f"u{d}"], local, mask, d == "b", steps[d]) for d in "fb"], axis=2)
    margin, a, pooled = _pool(parts, states, mask)
    p = _sigmoid(margin)
    total = weight.sum()
    loss = float((weight * np.logaddexp(0, np.where(y > 0, -margin, margin))).sum() / total)
    g: dict[str, np.ndarray] = {}
    d_margin = (weight * (p - y) / total).astype(x.dtype)
    g["out"], g["bias"] = pooled.T @ d_margin, np.array([d_margin.sum()], dtype=x.dtype)
    d_pooled = d_margin[:, None] * parts["out"][None, :]
    d_a = np.einsum("nh,tnh->tn", d_pooled, states)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    g["attend"] = np.einsum("tn,tnh->h", d_e, states)
    d_states = a[:, :, None] * d_pooled[None] + d_e[:, :, None] * parts["attend"][None, None, :]
    d_x = np.zeros_like(x)
    for k, d in enumerate("fb"):
        own = d_states[:, :, k * HIDDEN:(k + 1) * HIDDEN]
        u, w = parts[f"u{d}"], parts[f"w{d}"]
        d_u, d_gates, d_h = np.zeros_like(u), np.zeros((len(x), 3 * HIDDEN), dtype=x.dtype), np.zeros_like(own[0])
        for t, h, r, z, new, gh_new in reversed(steps[d]):
            d_h = d_h + own[t]
            live = mask[:, t, None]
            d_after = np.where(live, d_h, 0)
            d_pre_new = d_after * (1 - z) * (1 - new ** 2)
            d_pre_z = d_after * (h - new) * z * (1 - z)
            d_pre_r = d_pre_new * gh_new * r * (1 - r)
            d_gh = np.concatenate([d_pre_r, d_pre_z, d_pre_new * r], axis=1)
            d_gx = np.concatenate([d_pre_r, d_pre_z, d_pre_new], axis=1)
            d_u += h.T @ d_gh
            for c in range(3 * HIDDEN):
                d_gates[:, c] += np.bincount(local[:, t], weights=d_gx[:, c], minlength=len(x))
            d_h = np.where(live, d_after * z + d_gh @ u.T, d_h)
        g[f"u{d}"], g[f"w{d}"], g[f"b{d}"] = d_u, x.T @ d_gates, d_gates.sum(axis=0)
        d_x += d_gates @ w.T
    bucket, first = inputs.runs_of(used)
    share = np.repeat(d_x[:, WORD_DIMS:] / np.diff(first)[:, None], np.diff(first), axis=0)
    g["words"] = _sums(inputs.word_bucket[used], d_x[:, :WORD_DIMS])
    g["grams"] = _sums(bucket, share)
    return loss, g


def _sums(bucket: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` by bucket."""
    return np.stack([np.bincount(bucket, weights=column, minlength=BUCKETS) for column in values.T], axis=1).astype(values.dtype)


def _log_ratios(bucket: np.ndarray, text: np.ndarray, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """For each bucket the smoothed log ratio of the shares of toxic and other texts of ``use`` that hold it, shrunk where few do."""
    seen = np.unique(text[use[text]] * BUCKETS + bucket[use[text]])
    toxic = y[seen // BUCKETS] == 1
    held = [np.bincount(seen[m] % BUCKETS, minlength=BUCKETS) for m in (toxic, ~toxic)]
    ratio = np.log((held[0] + 1) / (y[use].sum() + 2)) - np.log((held[1] + 1) / ((1 - y[use]).sum() + 2))
    return ratio * (held[0] + held[1]) / (held[0] + held[1] + 3)


def start_parts(inputs: Inputs, y: np.ndarray, seed: int = 3, dtype=np.float32, use: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Random starting values and log ratios; the latter see only the texts marked in ``use`` (default: all)."""
    use = np.ones(len(y), dtype=bool) if use is None else use
    rng = np.random.default_rng(seed)
    dims = WORD_DIMS + GRAM_DIMS
    parts = {"words": rng.normal(0, 0.05, (BUCKETS, WORD_DIMS)), "grams": rng.normal(0, 0.05, (BUCKETS, GRAM_DIMS)),
             "attend": rng.normal(0, 0.1, 2 * HIDDEN), "out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
    for d in "fb":
        parts |= {f"w{d}": rng.normal(0, 0.4, (dims, 3 * HIDDEN)), f"u{d}": rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)), f"b{d}": np.zeros(3 * HIDDEN)}
    text = np.repeat(np.arange(len(y)), np.diff(inputs.first))
    parts["words"][:, 0] = _log_ratios(inputs.word_bucket[inputs.word_of], text, y, use) / 2
    pairs = np.unique(text * len(inputs.word_bucket) + inputs.word_of)
    pair_text, pair_word = pairs // len(inputs.word_bucket), pairs % len(inputs.word_bucket)
    runs = np.diff(inputs.gram_first)[pair_word]
    gram = np.repeat(inputs.gram_first[pair_word] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
    parts["grams"][:, 0] = _log_ratios(inputs.gram_bucket[gram], np.repeat(pair_text, runs), y, use) / 2
    return {k: v.astype(dtype) for k, v in parts.items()}


def train(data: np.ndarray, offsets: np.ndarray, y: np.ndarray, prior: float, rounds: int = 5, passes: int = 2, batch: int = 512,
          rate: float = 0.02, seed: int = 3) -> ToxicNet:
    """The network for texts with labels ``y``; every fifth text only fits the logistic curve."""
    if len(set(y.tolist())) < 2:
        return ToxicNet(constant=float(y[0]) if len(y) else 0.0)
    held = np.arange(len(y)) % 5 == 4
    inputs = Inputs(data, offsets)
    if len(set(y[~held].tolist())) < 2:
        held[:] = False
    parts = start_parts(inputs, y, seed, use=~held)
    rng = np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
    step = 0
    for turn in range(rounds):
        if turn:
            margin, start, text = window_margins(parts, inputs)
        else:  # an untrained network cannot choose: take the windows whose words' starting ratios are highest
            start, text = inputs.windows()
            x = inputs.vectors(parts)
            tokens, mask = inputs.tokens(start, text)
            margin = np.where(mask, (x[:, 0] + x[:, WORD_DIMS])[tokens], -np.inf).max(axis=1)
        order = np.lexsort((-margin, text))
        rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        best = order[(rank < np.where(y[text[order]] == 1, 1, 4)) & ~held[text[order]]]
        others = np.flatnonzero((y[text] == 0) & ~held[text])
        picks = np.concatenate([best, rng.choice(others, min(len(others), len(best)), replace=False)])
        weight = np.where(y[text[picks]] == 1, 0.5 / max(1, (y[text[picks]] == 1).sum()), 0.5 / max(1, (y[text[picks]] == 0).sum()))
        for _ in range(passes):
            for at in np.array_split(rng.permutation(len(picks)), max(1, len(picks) // batch)):
                k = picks[at]
                _, g = loss_and_gradients(parts, inputs, start[k], text[k], y[text[k]], weight[at])
                step += 1
                for name, grad in g.items():
                    first[name] = 0.9 * first[name] + 0.1 * grad
                    second[name] = 0.999 * second[name] + 0.001 * grad ** 2
                    # The tables follow slowly, or they would learn single texts by heart.
                    scale = (rate / 20 if name in ("words", "grams") else rate) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                    parts[name] = (parts[name] - scale * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    margins = text_margins(parts, data, offsets)
    on = held if len(set(y[held].tolist())) == 2 else ~held
    slope, offset = logistic_curve(margins[on], y[on], prior)
    return ToxicNet(parts, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, exclude=None, label: str = "toxic", per_class: int = PER_CLASS,
        id_col: str = "doc_id", text_col: str = "text") -> ToxicNet:
    """Fit on at most ``per_class`` labelled texts of each class, in one task; ``exclude`` (over ``labels``) marks ids that
    must not be learnt from."""
    exclude = F.lit(False) if exclude is None else exclude
    picks = sample_labels(labels, label, exclude, per_class, id_col)
    share = labels.where(~exclude & F.col(label).isin(0, 1)).agg(F.avg(label).alias("p")).first()["p"]
    prior = min(max(0.5 if share is None else float(share), 0.05), 0.95)
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(picks), "_id")
             .withColumn("_one", F.lit(1)))

    def one_task(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(_text=frame["_text"].fillna("")).sort_values(["_id", "_text"], kind="stable")
        data, offsets = utf8_buffer(pa.array(frame["_text"].tolist(), type=pa.large_string()))
        return pd.DataFrame({"net": [train(data, offsets, frame["_y"].to_numpy().astype(np.int64), prior).packed()]})

    made = texts.groupBy("_one").applyInPandas(one_task, "net binary").collect()
    return ToxicNet.unpacked(bytes(made[0]["net"])) if made else ToxicNet(constant=0.0)


def score(docs: DataFrame, net: ToxicNet, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that a whole text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(net.packed())
    loaded: list[ToxicNet] = []

    def scored(batch: pa.RecordBatch) -> list[pa.Array]:
        if not loaded:
            loaded.append(ToxicNet.unpacked(shared.value))
        model = loaded[0]
        if model.constant is not None:
            return [pa.array(np.full(batch.num_rows, model.constant))]
        margin = text_margins(model.parts, *utf8_buffer(batch.column(text_col)))
        return [pa.array(_sigmoid(np.clip(model.slope * margin + model.offset, -30, 30)))]

    return map_batches(docs, scored, f"{score_col} double", keep=keep)


def op1_toxicity_gru(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows whose id has crc32 mod 4 = 2 are held out of the fit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = fit(docs, labels, exclude=id_fold(F.col("doc_id"), 4) == 2)
    return (score(docs, net, keep=["doc_id"])
            .select("doc_id", (id_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                    (F.col("score") >= SCORE_CUT).cast("int").alias("predicted")))
