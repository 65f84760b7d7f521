"""Splits: exact quotas and the distributed rank primitive."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from textlab.operators import splits as SP


def _fixture(spark, n=309, pos=89):
    rows = [(i, 1 if i < pos else 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, label int")


def test_stratified_split_quota_matches_reference_ratio(spark):
    folds = SP.stratified_splits(_fixture(spark), "doc_id", "label", 10, 0.3, 42)
    per = {(r.fold, r.role, r.label): r.n for r in folds.groupBy("fold", "role", "label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    for f in range(10):
        assert per[(f, "test", 1)] == 27
        assert per[(f, "test", 0)] == 66
        assert per[(f, "train", 1)] + per[(f, "train", 0)] == 309 - 93
    # Different folds draw different test sets.
    t0 = {r.doc_id for r in folds.filter("fold = 0 AND role = 'test'").collect()}
    t1 = {r.doc_id for r in folds.filter("fold = 1 AND role = 'test'").collect()}
    assert t0 != t1


def test_fold_unit_example(spark):
    # Ten texts, labels alternating: ceil(0.3 * 10) = 3 test rows; shares
    # 1.5 / 1.5 tie on the remainder, the smaller class value gets the extra.
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id bigint, label int")
    folds = SP.stratified_splits(df, "doc_id", "label", 5, 0.3, 42)
    per = {(r.fold, r.label): r["count"] for r in folds.filter("role = 'test'").groupBy("fold", "label").count().collect()}
    assert len(per) == 10
    assert all(per[(f, 0)] == 2 and per[(f, 1)] == 1 for f in range(5))


def test_exact_rank_equals_window(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 3).alias("g"),
                                      F.xxhash64("id").alias("k")).repartition(7)
    ours = SP.exact_rank(df, ["g"], ["k", "id"], num_partitions=5)
    ref = df.withColumn("r2", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")))
    bad = ours.join(ref.select("id", "r2"), "id").filter(F.col("rank") != F.col("r2")).count()
    assert bad == 0
    assert ours.count() == 5000


def test_kfold_balanced(spark):
    folds = SP.stratified_kfold(_fixture(spark), "doc_id", "label", 5, 42)
    sizes = sorted(r["count"] for r in folds.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 2


def test_fold_cache_hit_and_data_key(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tl-cache-")
    df = spark.createDataFrame([(i, i % 2, f"t{i}") for i in range(40)], "doc_id bigint, label int, text string")
    a = SP.cached_folds(df, "doc_id", "label", "text", root, 3)
    b = SP.cached_folds(df, "doc_id", "label", "text", root, 3)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    import os
    assert len(os.listdir(root)) == 1
    changed = df.withColumn("text", F.concat("text", F.lit("!")))
    SP.cached_folds(changed, "doc_id", "label", "text", root, 3)
    assert len(os.listdir(root)) == 2  # other data, other key
