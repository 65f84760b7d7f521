"""Label-quality audit: confident learning, review queue, histograms.

Confident learning (Northcutt et al., 2021) on out-of-sample probabilities
for a binary label, expressed as aggregations:
1. per-class threshold t_j = mean p_j over rows whose given label is j;
2. confident joint C[i, j]: rows labelled i whose p_j >= t_j (argmax of the
   qualifying classes when both qualify);
3. calibrated C~[i, j] = C[i, j] / sum_j C[i, j] * n_i;
4. prune by noise rate: among rows labelled i, the round(C~[i, j]) rows with
   the largest margin p_j - p_i are issues (exact distributed rank, ties by
   id).
``label_quality`` = p(given label); ``predicted_label`` = argmax p.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators.splits import exact_rank


def _with_quality(scored: DataFrame, id_col: str, label_col: str, p_col: str) -> DataFrame:
    y, p1 = F.col(label_col), F.col(p_col)
    return scored.select(id_col, label_col, p_col,
                         F.when(y == 1, p1).otherwise(F.lit(1.0) - p1).alias("label_quality"),
                         (p1 >= 0.5).cast("int").alias("predicted_label"))


def label_quality(scored: DataFrame, id_col: str = "doc_id", label_col: str = "label",
                  p_col: str = "p1", digits: int = 6) -> DataFrame:
    """Quality and predicted label of every row, without the issue ranking (no shuffle)."""
    base = _with_quality(scored, id_col, label_col, p_col)
    return base.select(id_col, label_col, F.round("label_quality", digits).alias("label_quality"), "predicted_label")


def label_issues(scored: DataFrame, id_col: str = "doc_id", label_col: str = "label",
                 p_col: str = "p1", digits: int = 6) -> DataFrame:
    y, p1 = F.col(label_col), F.col(p_col)
    base = _with_quality(scored, id_col, label_col, p_col)
    # Class thresholds: two numbers (scalar subqueries).
    t1 = base.filter(y == 1).select(F.avg(p_col)).scalar()
    t0 = base.filter(y == 0).select(F.avg(F.lit(1.0) - p1)).scalar()
    q1, q0 = p1 >= t1, (F.lit(1.0) - p1) >= t0
    conf = (F.when(q1 & q0, F.when(p1 >= 0.5, 1).otherwise(0))
            .when(q1, 1).when(q0, 0).otherwise(F.lit(None))).cast("int")
    joint = base.withColumn("_conf", conf).groupBy(label_col).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("_conf").isNotNull(), 1).otherwise(0)).alias("_c_all"),
        F.sum(F.when(F.col("_conf").isNotNull() & (F.col("_conf") != y), 1).otherwise(0)).alias("_c_off"))
    prune = joint.select(label_col, F.round(F.col("_c_off") / F.nullif(F.col("_c_all"), F.lit(0)) * F.col("_n"))
                         .cast("bigint").alias("_k"))
    margin = F.when(y == 1, F.lit(1.0) - p1 - p1).otherwise(p1 - (F.lit(1.0) - p1))
    ranked = exact_rank(base.withColumn("_m", -margin), [label_col], ["_m", id_col])
    out = ranked.join(F.broadcast(prune), label_col, "left")
    return out.select(id_col, label_col, F.round("label_quality", digits).alias("label_quality"),
                      "predicted_label",
                      (F.col("rank") <= F.coalesce(F.col("_k"), F.lit(0))).alias("is_label_issue"))


def review_queue(issues: DataFrame, valuation: DataFrame, id_col: str = "doc_id",
                 label_col: str = "label", cut: float = 0.5) -> DataFrame:
    """Rows flagged by either audit (union of both id sets) with both flags:
    ``is_detrimental`` (valuation < cut), ``label_mismatch``."""
    v = valuation.select(id_col, "data_valuation_score")
    j = issues.join(v, id_col, "full")
    j = j.withColumn("is_detrimental", F.col("data_valuation_score") < cut).withColumn(
        "label_mismatch", F.col("predicted_label") != F.col(label_col))
    return j.filter(F.coalesce("is_label_issue", F.lit(False)) | F.coalesce("is_detrimental", F.lit(False)))


def issue_overlap(a: DataFrame, b: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sizes of two id sets, their intersection and union (one row)."""
    ia, ib = a.select(id_col).distinct(), b.select(id_col).distinct()
    tagged = ia.withColumn("_a", F.lit(1)).join(ib.withColumn("_b", F.lit(1)), id_col, "full")
    return tagged.agg(F.sum(F.coalesce("_a", F.lit(0))).cast("bigint").alias("n_a"),
                      F.sum(F.coalesce("_b", F.lit(0))).cast("bigint").alias("n_b"),
                      F.sum(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1).otherwise(0))
                      .cast("bigint").alias("n_intersection"),
                      F.count(F.lit(1)).alias("n_union"))


def score_histogram(df: DataFrame, score_col: str, label_col: str, lo: float = 0.0, hi: float = 1.0,
                    bins: int = 10) -> DataFrame:
    """(label, bin, n): equal-width bins over [lo, hi]; lower values fall in the first bin, hi and higher in the last."""
    s = F.col(score_col)
    b = F.greatest(F.least(F.floor((s - F.lit(lo)) / F.lit((hi - lo) / bins)).cast("int"), F.lit(bins - 1)), F.lit(0))
    return df.groupBy(label_col, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
