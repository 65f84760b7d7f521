import numpy as np
from pyspark.sql import functions as F

from textlab.llm.ann_forest import nearest, op4_ann_forest


def brute(rows, k=5):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in sorted({i for i in ids.tolist() if i % 50 == 0}):
        s = x @ x[np.flatnonzero(ids == q)[0]]
        others = np.flatnonzero(ids != q)
        order = others[np.lexsort((ids[others], -np.round(s[others], 12)))][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_all_leaves_equal_brute_force_with_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(250)]
    bad = [(400, None), (450, []), (500, [0.0] * 6), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] + [1.0] * 5),
           (650, [float("inf")] + [1.0] * 5), (700, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, score string")
    # Small blocks split the leaf that the copies share.
    got = found(nearest(df, F.col("id") % 50 == 0, trees=3, depth=3, share=1.0, block_vectors=40, block_queries=2))
    want = brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 3.0])], "vec_id long, embedding array<float>")
    assert [i for i, _ in found(nearest(df, F.col("id") % 50 == 0))[0]] == [1, 2]
    assert nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0 and nearest(df.limit(1), F.col("id") % 50 == 0).count() == 0


def test_recall(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got, want = found(op4_ann_forest(spark, path)), brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
