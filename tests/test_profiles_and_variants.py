"""Intervals over rating profiles (A6) and all text variants in one plan."""

import collections
import math

import numpy as np
from pyspark.sql import functions as F

from textlab.functions.tokens import tokens
from textlab.operators import agreement as A
from textlab.operators import features as X
from textlab.operators import report as RP
from textlab.operators import rules as R


def _long(spark, n):
    rows = spark.range(n).select(F.col("id").alias("object_id"), F.explode(F.array(*[F.lit(r) for r in (1, 2, 3)])).alias("rater"))
    score = F.when((F.col("object_id") + F.col("rater") * 7) % 5 < 2, 1).when(F.col("object_id") % 97 == 0, F.lit(None)).otherwise(0)
    return rows.withColumn("score", score.cast("int"))


def test_rows_formed_do_not_grow_with_objects(spark):
    for n in (100, 20_000):
        long = _long(spark, n)
        profiles = A.rating_profiles(long)
        counts = collections.defaultdict(collections.Counter)
        for r in long.filter("score is not null").collect():
            counts[r["object_id"]][r["score"]] += 1
        want = collections.Counter(",".join(f"{k}x{v}" for k, v in sorted(c.items())) for c in counts.values() if sum(c.values()) >= 2)
        assert {r["profile"]: r["m"] for r in profiles.collect()} == dict(want)
        assert A.poisson_weights(profiles, 200).count() == 200 * len(want) <= 200 * 7


def test_weights_are_poisson(spark):
    cells = "array(named_struct('score', 1, 'n_k', 2L)) as cells"
    for m in (1, 3, 64, 65, 1000, 10**9):
        one = spark.range(1).selectExpr(f"'p{m}' as profile", f"{m}L as m", cells)
        w = np.array([r["w"] for r in A.poisson_weights(one, 4000).select("w").collect()], dtype=float)
        assert abs(w.mean() - m) < 5 * math.sqrt(m / 4000) and 0.85 < w.var() / m < 1.15, (m, w.mean(), w.var())
    same = [A.poisson_weights(one, 10, s).select("w").collect() for s in (1, 1, 2)]
    assert same[0] == same[1] != same[2]


def test_interval_holds_the_estimate_and_edges(spark):
    long = _long(spark, 5000)
    est = {r["score"]: r["agreement"] for r in A.category_agreement(long).collect()}
    ci = {r["score"]: r for r in A.category_agreement_ci(long).collect()}
    assert set(ci) == set(est) and all(ci[s]["ci_low"] < est[s] < ci[s]["ci_high"] for s in est)
    assert all(ci[s]["ci_high"] - ci[s]["ci_low"] < 0.1 for s in est)
    assert A.category_agreement_ci(long.limit(0)).count() == 0


DOCS = [(i, i % 2, f"alpha beta {'gain' if i % 2 else 'loss'} word{i % 4} end", f"Title {i % 3}") for i in range(60)]


def test_all_variants_at_once_equal_one_by_one(spark):
    docs = spark.createDataFrame(DOCS + [(99, 1, None, None), (100, None, "gain", "t")], "doc_id long, label int, text string, title string")
    variants = {"a": tokens("text"), "b": tokens(F.concat_ws(" ", "title", "text")), "c": tokens(F.lit(""))}
    got = {r["text_col"]: r.asDict() for r in RP.compare_variants_at_once(docs, variants, min_df=2, threshold=0.6).collect()}
    for name, toks in variants.items():
        one = R.rule_baseline(docs.select("label", toks.alias("tokens")), min_df=2, threshold=0.6).first().asDict()
        assert {k: got[name][k] for k in one} == one, name
    assert sorted(r["rank"] for r in got.values()) == [1, 2, 3] and got["c"]["num_rules"] == 0
    empty = RP.compare_variants_at_once(docs.limit(0), variants, min_df=2).collect()
    assert len(empty) == 3 and all(r["n"] == 0 and r["num_rules"] == 0 for r in empty)


def test_vocabulary_cut_is_the_same_by_either_plan(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, label int, text string, title string").select("label", tokens("text").alias("tokens"))
    stats = X.term_stats(docs, "tokens", ["label"], 1, 2)
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    got = []
    for bound in ("1", "5000"):
        spark.conf.set(key, bound)
        got.append(sorted(R.grouped_vocabulary(stats, ["label"], 2, 4).collect()))
    spark.conf.set(key, before)
    assert got[0] == got[1] and len(got[0]) == 8


def test_null_tokens_count_for_nothing(spark):
    df = spark.createDataFrame([(1, ["b", None, "a", "b", None])], "doc_id int, tokens array<string>")
    assert sorted((r["term"], r["tf"]) for r in X.term_freqs(df).collect()) == [("a", 1), ("b", 2)]
