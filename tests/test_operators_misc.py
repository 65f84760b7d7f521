"""Augmentation, stemming paths, packing, kNN (with copies), SMOTE, training."""

import math
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from textlab.functions import stem as ST
from textlab.operators import augment as AG
from textlab.operators import corpus as C
from textlab.operators import knn as KN
from textlab.operators import splits as SP
from textlab.operators import train as TR


def test_augment_rounds_carry_labels(spark):
    rows = [(i, i % 2, f"Title{i} (Cat: x; Who: y): " + " ".join(f"w{j}" for j in range(12))) for i in range(20)]
    base = spark.createDataFrame(rows, "doc_id long, label int, text string")
    out = AG.augment_rounds(base, "doc_id", "text", "label", rounds=2)
    assert out.filter("round = 0").count() == 20
    lab = {r.doc_id: r.label for r in base.collect()}
    for r in out.filter("round > 0").collect():
        assert r.label == lab[r.doc_id]
        assert "(Cat: x; Who: y):" in r.text  # metadata put back
    assert sorted(r.position for r in out.collect()) == list(range(1, out.count() + 1))


def test_augment_folds_no_leak(spark):
    rows = [(i, i % 2, "T (m): " + " ".join(f"w{j}" for j in range(10))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, label int, text string")
    folds = SP.stratified_splits(docs, "doc_id", "label", 3, 0.3, 42)
    aug = AG.augment_folds(docs, folds, "doc_id", "text", "label", factor=2)
    leaked = aug.filter("round > 0").join(folds.filter("role = 'test'").select("fold", "doc_id"), ["fold", "doc_id"])
    assert leaked.count() == 0
    assert aug.filter("round > 0 AND role = 'test'").count() == 0


def test_stem_tokens_udf_and_join_agree(spark):
    df = spark.createDataFrame([(1, ["politik", "für", "bildung"]), (2, ["bekämpfung", "leben", "politik"])],
                               "doc_id long, tokens array<string>")
    a = {r.doc_id: r.tokens for r in ST.stem_tokens(df, "tokens", method="udf").collect()}
    b = {r.doc_id: r.tokens for r in ST.stem_tokens(df, "tokens", id_col="doc_id", method="join").collect()}
    assert a == b == {1: ["polit", "fur", "bildung"], 2: ["bekampf", "leb", "polit"]}


def test_pack_blocks_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, [f"t{i}_{j}" for j in range(rnd.randint(0, 30))]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, tok array<string>")
    got = {(r.batch, r.block): r.tokens for r in C.pack_blocks(df, "doc_id", "tok", block=16, batch_docs=7).collect()}
    want = {}
    for b in range(0, 40, 7):
        stream = [t for _, toks in rows[b:b + 7] for t in toks]
        for k in range(len(stream) // 16):
            want[(b // 7, k)] = stream[k * 16:(k + 1) * 16]
    assert got == want


def _brute_knn(vecs, k):
    out = {}
    for i, a in vecs.items():
        ds = sorted((round(math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b))), 9), j) for j, b in vecs.items() if j != i)
        out[i] = [j for _, j in ds[:k]]
    return out


def test_knn_exact_with_hot_copies(spark):
    rnd = random.Random(7)
    vecs = {i: [rnd.gauss(0, 1) for _ in range(4)] for i in range(60)}
    hot = [0.5, 0.5, 0.5, 0.5]
    for i in range(60, 100):  # a group of 40 identical copies
        vecs[i] = list(hot)
    df = spark.createDataFrame([(i, v) for i, v in vecs.items()], "id long, v array<double>")
    got = {}
    for r in KN.knn(df, "id", "v", k=5, n_pivots=6).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor_id))
    got = {i: [n for _, n in sorted(x)] for i, x in got.items()}
    assert got == _brute_knn(vecs, 5)


def test_smote_is_convex(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.random(), rnd.random()], 1 if i < 8 else 0) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    syn = KN.smote(df, "id", "v", "label", minority=1, k=3)
    assert syn.count() == 22 - 8
    vec = {i: v for i, v, _ in rows}
    for r in syn.collect():
        a, b = vec[r.base_id], vec[r.neighbor_id]
        for x, p, q in zip(r.vector, a, b):
            assert min(p, q) - 1e-6 <= x <= max(p, q) + 1e-6


def test_classifier_guard_and_persistence(spark):
    one = spark.createDataFrame([(1, ["a", "b"], 1), (2, ["b"], 1)], "doc_id long, tokens array<string>, label int")
    with pytest.raises(ValueError):
        TR.fit_text_classifier(one)
    rows = [(i, ["good", "fine"] if i % 2 else ["bad", "poor"], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, label int")
    m = TR.fit_text_classifier(df, max_features=10, epochs=10)
    p = tempfile.mkdtemp(prefix="tl-model-") + "/m"
    from textlab.sources.io import load_model, save_model
    save_model(m, p)
    a = [r.p1 for r in TR.predict_proba(m, df).orderBy("doc_id").collect()]
    b = [r.p1 for r in TR.predict_proba(load_model(p), df).orderBy("doc_id").collect()]
    assert a == b
    assert TR.predict_proba(m, df).filter("pred = label").count() == 40


def test_rule_scoring_equals_plain_search(spark, sf_dir):
    from textlab.functions.tokens import tokens
    from textlab.operators import rules as R
    from textlab.plans.views import labelled_docs
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text").alias("tokens"))
    rules = R.mine_rules(docs, "label", "tokens", min_df=3, max_features=1000, threshold=0.94)
    rules = spark.createDataFrame(rules.collect(), rules.schema)
    got = {r["doc_id"]: (r["pred"], r["matched_rule"]) for r in R.predict_rules(docs, rules).collect()}
    patterns = [r["pattern"] for r in rules.orderBy("rank").collect()]
    for r in docs.collect():
        text = " ".join(r["tokens"])
        first = next((p for p in patterns if p in text), None)
        assert got[r["doc_id"]] == (int(first is not None), first)
    empty = rules.limit(0)
    assert R.predict_rules(docs, empty).filter("pred = 1").count() == 0


def test_idf_fit_apply_equals_tfidf(spark):
    from textlab.operators.features import idf_table, term_freqs, tfidf, tfidf_apply
    rows = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, []), (4, ["a", "a", "a", "d"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    tf = {(r.doc_id, r.term): r.tf for r in term_freqs(df).collect()}
    assert tf == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1, (2, "c"): 1, (4, "a"): 3, (4, "d"): 1}
    one = {(r.doc_id, r.term): round(r.weight, 9) for r in tfidf(df, digits=None).collect()}
    two = {(r.doc_id, r.term): round(r.weight, 9) for r in tfidf_apply(df, idf_table(df)).collect()}
    assert one == two


def test_pack_blocks_null_and_repeated_ids(spark):
    """Null ids and rows with the same id keep all their tokens, once each."""
    rows = [(None, ["n"] * 5), (None, ["m"] * 3), (7, ["a"] * 4), (7, ["b"] * 4), (7, ["a"] * 4), (9, None), (9, []), (10, ["c"] * 12)]
    df = spark.createDataFrame(rows, "doc_id long, tok array<string>")
    got = C.pack_blocks(df, "doc_id", "tok", block=8, batch_docs=100).orderBy("block").collect()
    tokens = [t for r in got for t in r.tokens]
    assert [len(r.tokens) for r in got] == [8, 8, 8, 8] and sorted(tokens) == sorted("n" * 5 + "m" * 3 + "a" * 8 + "b" * 4 + "c" * 12)
    assert set(tokens[:8]) == {"n", "m"} and set(tokens[8:20]) == {"a", "b"} and set(tokens[20:]) == {"c"}


def test_splits_need_no_sort_or_checkpoint(spark):
    from textlab.operators.splits import stratified_splits
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(500)], "doc_id long, label boolean")
    folds = stratified_splits(df, "doc_id", "label", 2)
    plan = folds._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Sort [" not in plan and "LogicalRDD" not in plan.replace("LogicalRDD [doc_id", "")
    assert folds.where("role = 'test'").groupBy("fold").count().select("count").distinct().first()[0] == 150
