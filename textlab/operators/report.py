"""Reporting: variant comparison, top-k tables, retrieval, next-round sample.

Retrieval scores every vector against one query vector (a class centroid),
a linear scan, then keeps a bounded top-k; no pairwise work.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.hashing import h60, hash_key
from textlab.operators.rules import rule_baseline_by_group
from textlab.operators.splits import exact_rank
from textlab.session import checkpoint_dir


def compare_variants(variants: Mapping[str, DataFrame], evaluate: Callable[[DataFrame], DataFrame],
                     stamp: bool = False) -> DataFrame:
    """Run ``evaluate`` on each text variant; one row per variant with
    ``text_col`` and its rank by f1 (desc, then name)."""
    out = None
    for name, df in variants.items():
        r = evaluate(df).withColumn("text_col", F.lit(name))
        out = r if out is None else out.unionByName(r)
    # At most one row per variant.
    out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.col("f1").desc(), F.col("text_col"))))
    if stamp:
        out = out.withColumn("run_at", F.current_timestamp())
    return out


def compare_variants_at_once(docs: DataFrame, variants: Mapping[str, Column], label_col: str = "label",
                             stamp: bool = False, **mine_kwargs) -> DataFrame:
    """R1 with the rule baseline: all text variants (name -> array<string> of tokens) in one plan.

    The variants are unpivoted, (variant, tokens) rows of the same document, so that documents are scanned once to mine
    and once to predict instead of twice for each variant."""
    arms = F.array(*[F.struct(F.lit(name).alias("text_col"), toks.alias("tokens")) for name, toks in variants.items()])
    rows = docs.select(F.col(label_col).alias("label"), F.inline(arms))
    out = rule_baseline_by_group(rows, "text_col", list(variants), "label", "tokens", **mine_kwargs)
    # One row per variant.
    out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.col("f1").desc(), F.col("text_col"))))
    return out.withColumn("run_at", F.current_timestamp()) if stamp else out


def centroid(vectors: DataFrame, vec_col: str) -> Column:
    """Element-wise mean vector (scalar subquery; length = vector dimension)."""
    ex = vectors.select(F.posexplode(vec_col).alias("_i", "_v")).groupBy("_i").agg(F.avg("_v").alias("_m"))
    arr = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"])
    return ex.select(arr.alias("c")).scalar()


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    na = F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))
    nb = F.sqrt(F.aggregate(F.transform(b, lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))
    return dot / F.nullif(na * nb, F.lit(0.0))


def cosine_rank(candidates: DataFrame, vec_col: str, query: Column, id_col: str, k: int,
                most_similar: bool = True, digits: int = 6) -> DataFrame:
    """The k candidates most (or least) similar to ``query``."""
    s = candidates.withColumn("_q", query).withColumn("score", F.round(cosine(F.col(vec_col), F.col("_q")), digits))
    order = [F.col("score").desc() if most_similar else F.col("score").asc(), F.col(id_col).asc()]
    return s.drop("_q").orderBy(*order).limit(k)


def next_round_sample(predicted: DataFrame, id_col: str = "doc_id", pred_col: str = "pred",
                      seed: int = 42) -> DataFrame:
    """Every predicted positive plus as many predicted negatives, drawn in
    md5(seed:id) order.

    The predictions are made once and checkpointed: they are read to count the positives, to return them, and (twice) to
    rank the negatives."""
    checkpoint_dir(predicted.sparkSession)
    predicted = predicted.checkpoint(eager=True)
    pos = predicted.filter(F.col(pred_col) == 1).withColumn("stratum", F.lit("predicted_positive"))
    n_pos = pos.select(F.count(F.lit(1))).scalar()
    neg = predicted.filter(F.col(pred_col) == 0).withColumn("_h", h60(hash_key(F.lit(seed), id_col)))
    neg = exact_rank(neg, [], ["_h", id_col], "_rk").filter(F.col("_rk") <= n_pos).drop("_h", "_rk")
    return pos.unionByName(neg.withColumn("stratum", F.lit("sampled_negative")))
