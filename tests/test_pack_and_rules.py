"""Tokens are shuffled once to be found and once to their blocks; a prediction without explanation equals one with it."""

import pytest

from textlab.operators import corpus as C
from textlab.operators import rules as R


def test_the_tokens_share_one_shuffle_with_the_join(spark):
    # Row 3 comes three times, two of them equal; one id is null.
    rows = [(i, [f"w{i}_{j}" for j in range(i)]) for i in range(9)] + [(3, ["a"]), (3, ["a"]), (None, ["n"]), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, tok array<string>")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = C.pack_blocks(df, "doc_id", "tok", block=4, batch_docs=100)
        plan = out._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        found = sorted(t for r in out.collect() for t in r["tokens"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "SortAggregate" not in plan and "coalesce(_id" not in plan
    assert plan.count("Exchange hashpartitioning(_key") == 2  # the tokens' and the ranks'
    whole = sorted(t for _, toks in rows for t in toks or [])
    assert len(found) == len(whole) // 4 * 4 and set(found) <= set(whole) and found.count("a") == 2


def test_predictions_without_explanation_are_the_same(spark):
    rules = spark.createDataFrame([(1, "a b"), (2, "b"), (3, "cat food"), (4, "at"), (5, "zz")], "rank long, pattern string")
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["cat"]), (3, ["fo"]), (4, []), (5, None), (6, ["x", "zz"])], "doc_id long, tokens array<string>")
    plain = R.predict_rules(docs, rules).select("doc_id", "pred").orderBy("doc_id").collect()
    assert R.predict_rules(docs, rules, explain_col=None).select("doc_id", "pred").orderBy("doc_id").collect() == plain
    assert [r["pred"] for r in plain] == [1, 1, 0, 0, 0, 1]


@pytest.mark.parametrize("seed", [0, 1])
def test_baseline_counts_all_rules(spark, seed):
    rows = [("v", int(i % 2 == seed), ["same", f"p{i % 2}", f"q{i % 2}"]) for i in range(12)]
    docs = spark.createDataFrame(rows, "v string, label int, tokens array<string>")
    settings = dict(min_df=1, max_features=50, threshold=0.5, ngram_range=(1, 2))
    got = R.rule_baseline_by_group(docs, "v", ["v"], **settings).first().asDict()
    one = R.rule_baseline(docs, **settings).first().asDict()
    assert {k: got[k] for k in one} == one and one["num_rules"] > 2
