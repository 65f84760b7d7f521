"""Discriminative word rules: mining (K1), scoring (K2), baseline (K3).

A rule is a word n-gram whose count in the positive class dominates its count
in the negative class: ``score = pos / (pos + neg + 1)``.  The per-class
vocabulary cut (``min_df`` documents, then the ``max_features`` most frequent)
is made within each class, so a term cut from the negative side counts as 0.

The rule list is bounded by ``max_features`` rows, which is what makes it safe
to ship to every task as one array (a scalar subquery, not a driver collect).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.metrics import binary_metrics
from textlab.functions.tokens import normalized_text
from textlab.operators.features import term_stats


#: Parts of a group in ``grouped_vocabulary``; each hands at most ``max_features`` rows to the group's final cut.
VOCABULARY_PARTS = 64


def grouped_vocabulary(stats: DataFrame, group_cols: Sequence[str], min_df: int, max_features: int) -> DataFrame:
    """Per group the ``max_features`` most frequent terms with df >= min_df (ties: term ascending), for any number of groups.

    Up to the session's window group limit every task cuts its own rows of a group before they are shuffled.  For a larger
    ``max_features`` the cut is made within parts of a group first (by a hash of the term), so that one task never sees
    more than VOCABULARY_PARTS x max_features rows of a group.  The result is the same.
    """
    g = list(group_cols)
    order = [F.col("total").desc(), F.col("term").asc()]
    part = F.pmod(F.xxhash64("term"), F.lit(VOCABULARY_PARTS))
    rows = stats.filter(F.col("df") >= min_df).withColumn("_part", part)
    bound = int(stats.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    for keys in [g] if max_features <= bound else [g + ["_part"], g]:
        rows = rows.withColumn("_rk", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rk") <= max_features)
    return rows.drop("_rk", "_part")


def mine_rules(docs: DataFrame, label_col: str = "label", tokens_col: str = "tokens",
               min_df: int = 3, max_features: int = 1000, threshold: float = 0.94,
               ngram_range: tuple[int, int] = (1, 2), digits: int = 6, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rules ranked by score desc, pos desc, pattern asc; with ``group_cols`` those of every group of rows, in one plan.

    Columns: the group's, rank bigint, pattern string, pos bigint, neg bigint, score double.  Both classes' vocabularies
    come from one aggregation over ``docs``.
    """
    g = list(group_cols)
    stats = term_stats(docs.select(*g, F.col(label_col).alias("_cls"), tokens_col).filter(F.col("_cls").isin(0, 1)),
                       tokens_col, [*g, "_cls"], ngram_range[0], ngram_range[1])
    vocab = grouped_vocabulary(stats, [*g, "_cls"], min_df, max_features)
    # One row per term from at most 2 x max_features vocabulary rows of a group.
    both = vocab.groupBy(*g, "term").agg(
        F.sum(F.when(F.col("_cls") == 1, F.col("total"))).alias("pos"),
        F.sum(F.when(F.col("_cls") == 0, F.col("total"))).alias("neg"))
    scored = (both.filter(F.col("pos") > 0)
              .select(*g, F.col("term").alias("pattern"), F.col("pos").cast("bigint").alias("pos"),
                      F.coalesce("neg", F.lit(0)).cast("bigint").alias("neg"))
              .withColumn("score", F.col("pos") / (F.col("pos") + F.col("neg") + F.lit(1)))
              .filter(F.col("score") > F.lit(threshold)))
    # The rank over at most max_features rows of a group.
    w = Window.partitionBy(*g).orderBy(F.col("score").desc(), F.col("pos").desc(), F.col("pattern").asc())
    return scored.select(
        *g, F.row_number().over(w).cast("bigint").alias("rank"), "pattern", "pos", "neg",
        F.round("score", digits).alias("score"))


def rule_baseline_by_group(docs: DataFrame, group_col: str, groups: Sequence[str], label_col: str = "label",
                           tokens_col: str = "tokens", **mine_kwargs) -> DataFrame:
    """``rule_baseline`` of every group in one plan; a group without rows gets a row of zeros.

    Two passes over ``docs``, whatever the number of groups: one mines, one predicts.  The rules travel as one array a
    group, at most ``len(groups) x max_features`` patterns in all, which is the bound of the broadcast.
    """
    rules = mine_rules(docs, label_col, tokens_col, group_cols=[group_col], **mine_kwargs)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "pattern"))), lambda r: r["pattern"])
    arrays = rules.groupBy(group_col).agg(ordered.alias("_rules"))
    arr = F.coalesce("_rules", F.array().cast("array<string>"))
    pred = (docs.select(group_col, label_col, normalized_text(tokens_col).alias("_text"))
            .join(F.broadcast(arrays), group_col, "left").withColumn("_rules", arr))
    # Without an explanation the order of the tests is free; ``exists`` stops at the first match.
    pred = pred.select(group_col, label_col, F.size("_rules").cast("bigint").alias("num_rules"),
                       F.exists("_rules", lambda r: F.contains(F.col("_text"), r)).cast("int").alias("pred"))
    counts = binary_metrics(pred, label_col, "pred", [group_col, "num_rules"])
    spark = docs.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(g) for g in groups])).alias(group_col))
    return names.join(counts, group_col, "left").na.fill(0).select(*[c for c in counts.columns if c != "num_rules"], "num_rules")


def rule_array(rules: DataFrame):
    """All patterns in rank order as one array column (scalar subquery)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "pattern")))
    return rules.select(F.transform(ordered, lambda r: r["pattern"]).alias("r")).scalar()


def predict_rules(docs: DataFrame, rules: DataFrame, tokens_col: str = "tokens",
                  pred_col: str = "pred", explain_col: str | None = "matched_rule") -> DataFrame:
    """pred = 1 if any rule is a substring of the normalised text, else 0.

    ``matched_rule`` is the best-ranked matching rule (null if none).  An
    empty rule set predicts 0 everywhere.

    The rules are tested in rank order with ``contains``; the first match ends the test.
    """
    # The text and the rule array are projected into columns first: the
    # text must not be rebuilt once per rule inside the lambda, and a
    # subquery may not sit inside a lambda.
    out = docs.withColumn("_text", normalized_text(tokens_col)).withColumn(
        "_rules", F.coalesce(rule_array(rules), F.array().cast("array<string>")))
    text, arr = F.col("_text"), F.col("_rules")
    if not explain_col:
        # Which rule matches is not asked: ``exists`` stops at the first one.
        return out.withColumn(
            pred_col, F.coalesce(F.exists(arr, lambda r: F.contains(text, r)), F.lit(False)).cast("int")).drop("_rules", "_text")
    # First matching rule in rank order; once found, later rules are not
    # tested (And short-circuits on the null check).
    first = F.aggregate(arr, F.lit(None).cast("string"),
                        lambda acc, r: F.when(acc.isNull() & F.contains(text, r), r).otherwise(acc))
    out = out.withColumn("_first", first)
    out = out.withColumn(pred_col, F.col("_first").isNotNull().cast("int"))
    if explain_col:
        out = out.withColumnRenamed("_first", explain_col)
    return out.drop("_rules", "_text", "_first")


def rule_baseline(docs: DataFrame, label_col: str = "label", tokens_col: str = "tokens",
                  **mine_kwargs) -> DataFrame:
    """Mine on ``docs``, score the same rows, report metrics + rule count.

    These are resubstitution figures, as in the reference's baseline; use
    ``mine_rules`` on a train split and ``predict_rules`` on the test split for
    held-out figures.
    """
    rules = mine_rules(docs, label_col, tokens_col, **mine_kwargs)
    pred = predict_rules(docs, rules, tokens_col, explain_col=None)
    metrics = binary_metrics(pred, label_col, "pred")
    n_rules = rules.select(F.count(F.lit(1))).scalar()
    return metrics.withColumn("num_rules", n_rules)
