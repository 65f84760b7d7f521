import numpy as np
from pyspark.sql import functions as F

from textlab.llm import quality_nbsvm as Q


def test_dual_coordinate_descent_solves_the_primal():
    """The gradient of the primal objective vanishes at the result."""
    for seed in range(2, 12):
        rng = np.random.default_rng(seed)
        n, dims = 60, 8
        x = rng.normal(size=(n, dims))
        y = np.where(x[:, 0] + 0.3 * rng.normal(size=n) > 0.2, 1.0, -1.0)
        rows, first = np.tile(np.arange(dims), n), np.arange(n + 1) * dims
        w, b = Q.dual_coordinate_descent(rows, x.ravel(), first, y, dims, epochs=4000)
        share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
        slack = np.maximum(0, 1 - y * (x @ w + b)) * y * 2 * 0.5 / share
        assert np.abs(w - x.T @ slack).max() < 0.05 and abs(b - slack.sum()) < 0.05


def test_indicators_are_sets_and_ignore_neighbours():
    from textlab.llm.textkit import utf8_buffer
    import pyarrow as pa
    texts = ["ab ab cd", "ab cd", "", "éé x x x"]
    rows, first = Q.indicator_rows(*utf8_buffer(pa.array(texts)), Q.DIMS)
    for i, t in enumerate(texts):
        alone, _ = Q.indicator_rows(*utf8_buffer(pa.array([t])), Q.DIMS)
        assert rows[first[i]:first[i + 1]].tolist() == alone.tolist() == sorted(set(alone.tolist()))
    assert first[3] == first[2]


def test_held_out_accuracy(spark, sf_dir):
    got = Q.op10_quality_nbsvm(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out and quality is not null")
    r = got.agg(F.avg(F.expr("double(predicted = quality)")).alias("right"), F.min("score").alias("a"), F.max("score").alias("b")).first()
    assert r["right"] > 0.93 and 0 <= r["a"] <= r["b"] <= 1


def test_edge_rows(spark):
    rows = [(1, "good text", "q"), (1, "good text", "q"), (2, None, None), (3, "", ""), (None, "x " * 30000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    one = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    both = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (2, 0)], "doc_id long, quality int")
    assert {r["score"] > 0.99 for r in Q.score(docs, Q.fit(docs, one)).collect()} == {True}
    got = Q.score(docs, Q.fit(docs, both))
    assert got.dtypes[-1] == ("score", "double") and got.count() == 5 and Q.score(docs.limit(0), Q.fit(docs, both)).count() == 0
    assert Q.keep_good(docs, Q.fit(docs, both)).columns == docs.columns
