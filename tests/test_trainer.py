"""Distributed full-batch trainer equals a single-machine run of the same math."""

import numpy as np
import pytest

from textlab.operators import trainer as TR


def _fixture(spark, n=40, v=12, parts=3):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        y = i % 2
        idx = sorted(set(rng.integers(0, v // 2, 3).tolist()) | ({v // 2 + i % 3} if y else set()))
        vals = rng.random(len(idx)).round(3).tolist()
        rows.append((i, idx, vals, float(y), 1.0))
    df = spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>, y double, w double")
    return df.repartition(parts), rows, v


@pytest.mark.parametrize("loss", ["bce", "focal"])
def test_distributed_equals_local(spark, loss):
    df, rows, v = _fixture(spark)
    out = TR.train_mlp(df, v, hidden=(8, 4), epochs=5, lr=0.05, dropout=0.0, loss=loss)
    params = TR.init_params(v, (8, 4), 42)
    m = [np.zeros_like(p) for p in params]
    s = [np.zeros_like(p) for p in params]
    for t in range(1, 6):
        _, g = TR._forward_backward(params, [r[1] for r in rows], [r[2] for r in rows],
                                    np.array([r[3] for r in rows]), np.array([r[4] for r in rows]),
                                    0.0, np.random.default_rng(0), loss, 0.25, 2.0, len(rows))
        for i, gi in enumerate(g):
            m[i] = 0.9 * m[i] + 0.1 * gi
            s[i] = 0.999 * s[i] + 0.001 * gi * gi
            params[i] = params[i] - 0.05 * ((m[i] / (1 - 0.9 ** t)) / (np.sqrt(s[i] / (1 - 0.999 ** t)) + 1e-8)
                                            + 0.01 * params[i])
    for a, b in zip(out["params"], params):
        assert np.allclose(a, b, atol=1e-9)


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(3)
    params = TR.init_params(6, (5,), 7)
    idx = [[0, 2], [1, 3, 5], [4]]
    val = [[0.5, 1.0], [0.2, 0.3, 0.9], [1.5]]
    y, w = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])
    for loss in ("bce", "focal"):
        _, g = TR._forward_backward(params, idx, val, y, w, 0.0, rng, loss, 0.25, 2.0, 3)
        for pi in range(len(params)):
            flat = params[pi].ravel()
            for j in range(min(flat.size, 4)):
                old = flat[j]
                flat[j] = old + 1e-6
                lp, _ = TR._forward_backward(params, idx, val, y, w, 0.0, rng, loss, 0.25, 2.0, 3)
                flat[j] = old - 1e-6
                lm, _ = TR._forward_backward(params, idx, val, y, w, 0.0, rng, loss, 0.25, 2.0, 3)
                flat[j] = old
                assert abs((lp - lm) / 2e-6 / 3 - g[pi].ravel()[j]) < 1e-5


def test_learns_separable(spark):
    df, rows, v = _fixture(spark)
    out = TR.train_mlp(df, v, hidden=(8,), epochs=60, lr=0.05, dropout=0.2)
    pred = {r.doc_id: r.pred for r in TR.predict_mlp(df, out["params"], "doc_id").collect()}
    acc = np.mean([pred[r[0]] == r[3] for r in rows])
    assert acc >= 0.9 and out["losses"][-1] < out["losses"][0]
