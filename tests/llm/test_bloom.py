import numpy as np

from textlab.llm.bloom import bloom_of


def test_has_every_key_and_few_others(spark):
    keys = spark.range(-500, 4500).selectExpr("id * 7919 AS k")
    bloom = bloom_of(keys, "k")
    assert bloom.has(np.arange(-500, 4500) * 7919).all()
    others = np.arange(10_000, 30_000) * 7919
    assert bloom.has(others).mean() < 0.05
    assert not bloom_of(keys.limit(0), "k").has(others).any()
