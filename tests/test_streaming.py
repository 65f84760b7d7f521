"""Streaming rule scoring equals batch scoring on the same rows."""

import tempfile

from textlab.functions.tokens import tokens
from textlab.operators import rules as R
from textlab.plans.views import labelled_docs
from textlab.sources.tables import read_table
from textlab.streaming.rule_stream import score_batch, start_rule_scoring


def test_stream_equals_batch(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text").alias("tokens"))
    rules = R.mine_rules(docs, "label", "tokens", min_df=3, max_features=1000, threshold=0.94)
    rules = spark.createDataFrame(rules.collect(), rules.schema)  # a stored rule table
    src = tempfile.mkdtemp(prefix="tl-src-")
    all_docs = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "text")
    all_docs.repartition(3).write.mode("overwrite").parquet(src + "/in")
    sink, ck = tempfile.mkdtemp(prefix="tl-sink-"), tempfile.mkdtemp(prefix="tl-ck-")
    q = start_rule_scoring(spark, src + "/in", all_docs.schema, rules, sink + "/out", ck, once=True)
    q.awaitTermination(300)
    got = {(r.doc_id, r.pred, r.matched_rule) for r in spark.read.parquet(sink + "/out").collect()}
    want = {(r.doc_id, r.pred, r.matched_rule) for r in score_batch(all_docs, rules).collect()}
    assert got == want and len(got) == all_docs.count()
