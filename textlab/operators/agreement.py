"""Inter-coder agreement on a long rating table (rater, object, score).

Every statistic is one or two aggregations over the long table; the wide
form (one column per rater) is a keyed pivot.  No pair lists, no driver
loops.  Objects are the grouping key, so work spreads over objects.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.metrics import binary_metrics


def ratings_long(wide: DataFrame, object_col: str, rater_cols: Sequence[str],
                 rater_ids: Sequence[int] | None = None) -> DataFrame:
    """Wide (object, coder_1, coder_2, ...) -> long (rater, object, score)."""
    ids = list(rater_ids) if rater_ids is not None else list(range(1, len(rater_cols) + 1))
    pairs = ", ".join(f"{i}, `{c}`" for i, c in zip(ids, rater_cols))
    return wide.select(F.col(object_col).alias("object_id"),
                       F.expr(f"stack({len(ids)}, {pairs}) AS (rater, score)")).select(
        "rater", "object_id", "score")


def ratings_wide(long: DataFrame, raters: Sequence[int], complete: bool = True) -> DataFrame:
    """Long -> wide with columns coder_<r>; ``complete`` keeps only objects
    rated by every listed rater (an inner join of the rater tables)."""
    w = long.groupBy("object_id").pivot("rater", list(raters)).agg(F.first("score"))
    w = w.select("object_id", *[F.col(str(r)).alias(f"coder_{r}") for r in raters])
    if complete:
        w = w.dropna(subset=[f"coder_{r}" for r in raters])
    return w


def percent_agreement(wide: DataFrame, a: str, b: str) -> DataFrame:
    eq = (F.col(a) == F.col(b)).cast("int")
    return wide.agg(F.sum(eq).cast("bigint").alias("n_equal"), F.count(F.lit(1)).alias("n_total")).select(
        "n_equal", "n_total",
        F.round(F.col("n_equal") * 100.0 / F.nullif(F.col("n_total"), F.lit(0)), 6).alias("percent"))


def cohen_kappa(wide: DataFrame, a: str, b: str, digits: int = 9) -> DataFrame:
    """kappa = (po - pe) / (1 - pe) for two raters, any number of categories."""
    per_cat = wide.select(F.explode(F.array(
        F.struct(F.col(a).alias("k"), F.lit(1).alias("ca"), F.lit(0).alias("cb"),
                 (F.col(a) == F.col(b)).cast("int").alias("eq")),
        F.struct(F.col(b).alias("k"), F.lit(0).alias("ca"), F.lit(1).alias("cb"), F.lit(0).alias("eq")),
    )).alias("s")).groupBy(F.col("s.k").alias("k")).agg(
        F.sum("s.ca").alias("ca"), F.sum("s.cb").alias("cb"), F.sum("s.eq").alias("eq"))
    tot = per_cat.agg(F.sum("ca").alias("n"), F.sum("eq").alias("agree"),
                      F.sum(F.col("ca") * F.col("cb")).alias("cross"))
    po = F.col("agree") / F.col("n")
    pe = F.col("cross") / (F.col("n") * F.col("n"))
    return tot.select(F.col("n").cast("bigint").alias("n"), F.round(po, digits).alias("po"),
                      F.round(pe, digits).alias("pe"),
                      F.round((po - pe) / F.nullif(F.lit(1.0) - pe, F.lit(0.0)), digits).alias("kappa"))


def _object_category_counts(long: DataFrame) -> DataFrame:
    """(object_id, score, n_k, n_i): raters per category and per object."""
    per = long.filter(F.col("score").isNotNull()).groupBy("object_id", "score").agg(
        F.count(F.lit(1)).alias("n_k"))
    per_obj = long.filter(F.col("score").isNotNull()).groupBy("object_id").agg(
        F.count(F.lit(1)).alias("n_i"))
    return per.join(per_obj, "object_id")


def category_agreement(long: DataFrame, digits: int = 9) -> DataFrame:
    """Specific agreement per category for any number of raters:
    sum_i n_ik (n_ik - 1) / sum_i n_ik (n_i - 1) over objects with n_i >= 2."""
    c = _object_category_counts(long).filter(F.col("n_i") >= 2)
    return c.groupBy("score").agg(
        F.sum(F.col("n_k") * (F.col("n_k") - 1)).alias("num"),
        F.sum(F.col("n_k") * (F.col("n_i") - 1)).alias("den")).select(
        "score", F.round(F.col("num") / F.nullif(F.col("den"), F.lit(0)), digits).alias("agreement"))


def fleiss_kappa(long: DataFrame, digits: int = 9) -> DataFrame:
    """Fleiss' kappa; per-object rater counts may differ (n_i >= 2)."""
    c = _object_category_counts(long).filter(F.col("n_i") >= 2)
    per_obj = c.groupBy("object_id").agg(
        (F.sum(F.col("n_k") * (F.col("n_k") - 1)) / (F.first("n_i") * (F.first("n_i") - 1))).alias("p_i"))
    p_bar = per_obj.agg(F.avg("p_i").alias("p_bar"), F.count(F.lit(1)).alias("n_objects"))
    cat = c.groupBy("score").agg(F.sum("n_k").alias("nk"))
    pe = cat.agg((F.sum(F.col("nk") * F.col("nk")) / (F.sum("nk") * F.sum("nk"))).alias("p_e"))
    # Two one-row aggregates side by side: a scalar subquery, not a join.
    p_e = pe.select("p_e").scalar()
    return p_bar.select(
        F.col("n_objects").cast("bigint").alias("n_objects"), F.round("p_bar", digits).alias("p_bar"),
        F.round(p_e, digits).alias("p_e"),
        F.round((F.col("p_bar") - p_e) / (F.lit(1.0) - p_e), digits).alias("kappa"))


def mean_pairwise_agreement(wide: DataFrame, coders: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean over objects of the percent of agreeing coder pairs; the reference
    rounds each object's percent to 2 decimals before the mean (``rounded``),
    ``exact`` does not."""
    pairs = [(a, b) for i, a in enumerate(coders) for b in coders[i + 1:]]
    pct = sum(((F.col(a) == F.col(b)).cast("double") for a, b in pairs), F.lit(0.0)) / len(pairs) * 100
    return wide.select(pct.alias("pct")).agg(
        F.round(F.avg(F.round("pct", 2)), digits).alias("rounded"),
        F.round(F.avg("pct"), digits).alias("exact"))


def discrepancies(wide: DataFrame, a: str, b: str, expert: str, title: Column | None = None) -> DataFrame:
    """Objects where coders a and b agree with each other but not with the expert."""
    out = wide.filter((F.col(a) == F.col(b)) & (F.col(a) != F.col(expert)))
    cols = ["object_id"] + ([F.substring(title, 1, 60).alias("title")] if title is not None else [])
    return out.select(*cols, F.col(expert).alias("expert"), F.col(a).alias("coders"))


def coder_vs_expert(long: DataFrame, expert: int, digits: int = 6) -> DataFrame:
    """Per rater (other than the expert): confusion counts and metrics with the
    expert's label as truth.  ``truth`` is explicit: recall = tp / expert
    positives (the reference passes the coder as truth, which swaps recall and
    precision).  A last row with rater null holds the mean of the coders' metrics."""
    truth = long.filter(F.col("rater") == expert).select("object_id", F.col("score").alias("truth"))
    coders = long.filter(F.col("rater") != expert).select("rater", "object_id", F.col("score").alias("pred"))
    joined = coders.join(truth, "object_id")
    each = binary_metrics(joined, "truth", "pred", ["rater"], None)
    names = ["accuracy", "precision", "recall", "f1"]
    mean = each.agg(*[F.avg(m).alias(m) for m in names], F.count(F.lit(1)).alias("_n")).where("_n > 0").drop("_n")
    both = each.unionByName(mean, allowMissingColumns=True)
    return both.select("rater", "n", "tp", "fp", "fn", "tn", *[F.round(m, digits).alias(m) for m in names])


# Up to this mean a Poisson weight is drawn by inverting its distribution, beyond it by its normal expansion.
INVERTED_MEAN = 64


def rating_profiles(long: DataFrame) -> DataFrame:
    """(profile, m, cells): the distinct ways in which objects with two or more ratings were rated.

    ``cells`` is the object's sorted list of (score, n_k), ``profile`` its text form and ``m`` the number of objects
    that share it.  The table's size depends on raters and categories, not on the number of objects.
    """
    per = long.filter(F.col("score").isNotNull()).groupBy("object_id", "score").agg(F.count(F.lit(1)).alias("n_k"))
    cells = F.array_sort(F.collect_list(F.struct("score", "n_k")))
    objects = per.groupBy("object_id").agg(cells.alias("cells"), F.sum("n_k").alias("n_i")).filter("n_i >= 2")
    text = F.array_join(F.transform("cells", lambda c: F.concat_ws("x", c["score"].cast("string"), c["n_k"].cast("string"))), ",")
    return objects.groupBy("cells").agg(F.count(F.lit(1)).alias("m")).select(text.alias("profile"), "m", "cells")


def _poisson_cdf(mean: Column) -> Column:
    """P(K <= k) for k = 0, 1, ... until the rest is below double precision; for means up to INVERTED_MEAN."""
    last = (mean + 9 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def add(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda acc: acc["cdf"])


def poisson_weights(profiles: DataFrame, replicates: int, seed: int = 42) -> DataFrame:
    """``profiles`` x replicates with a weight ``w`` ~ Poisson(m): the sum of the Poisson(1) weights of its m objects.

    The draw comes from md5(seed:b:profile).  Means up to INVERTED_MEAN are inverted exactly; larger ones are rounded
    from m + sqrt(m) z + (z^2 - 1) / 6 with a normal z (the quantile's expansion, off by one at most now and then).
    """
    from textlab.functions.hashing import hash_key, unit
    m = F.col("m").cast("double")
    small = F.col("m") <= INVERTED_MEAN
    rows = profiles.withColumn("_cdf", F.when(small, _poisson_cdf(m)))
    rows = rows.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    rows = rows.withColumn("_u", unit(hash_key(F.lit(seed), "b", "profile")))
    rows = rows.withColumn("_v", unit(hash_key(F.lit(seed), "b", "profile", F.lit("angle"))))
    rest = F.greatest(F.lit(1.0) - F.col("_u"), F.lit(1e-17))  # its logarithm is finite
    rows = rows.withColumn("_z", F.sqrt(F.lit(-2.0) * F.log(rest)) * F.cos(F.lit(2 * math.pi) * F.col("_v")))
    z = F.col("_z")
    inverted = F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))).cast("bigint")
    expanded = F.greatest(F.lit(0), F.floor(m + F.sqrt(m) * z + (z * z - 1) / 6 + 0.5)).cast("bigint")
    return rows.select("profile", "m", "cells", "b", F.when(small, inverted).otherwise(expanded).alias("w"))


# Cumulative Poisson(1) probabilities P(K <= k), k = 0..7.
POISSON1_CDF = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238463,
                0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253]


def _poisson1(u: Column) -> Column:
    e = None
    for k, c in enumerate(POISSON1_CDF):
        e = F.when(u < F.lit(c), F.lit(k)) if e is None else e.when(u < F.lit(c), F.lit(k))
    return e.otherwise(F.lit(len(POISSON1_CDF)))


def object_weights(long: DataFrame, replicates: int, seed: int = 42) -> DataFrame:
    """(b, w, n_i, cells): one row per object with two or more ratings and replicate, its weight K ~ Poisson(1) drawn from
    md5(seed:b:object).  An object's categories stay in one row, so each weight is drawn once."""
    from textlab.functions.hashing import hash_key, unit
    per = long.filter(F.col("score").isNotNull()).groupBy("object_id", "score").agg(F.count(F.lit(1)).alias("n_k"))
    objects = per.groupBy("object_id").agg(F.collect_list(F.struct("score", "n_k")).alias("cells"), F.sum("n_k").alias("n_i")).filter(
        F.col("object_id").isNotNull() & (F.col("n_i") >= 2))
    rows = objects.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    return rows.select("b", _poisson1(unit(hash_key(F.lit(seed), "b", "object_id"))).alias("w"), "n_i", "cells")


def category_agreement_ci(long: DataFrame, replicates: int = 200, level: float = 0.95, seed: int = 42,
                          digits: int = 6) -> DataFrame:
    """Bootstrap interval of the specific agreement per category.

    Poisson(1) bootstrap over objects: every replicate draws a weight for every object (``object_weights``) and is one
    weighted aggregation, combined inside the tasks; the interval is the (1-level)/2 and (1+level)/2 percentiles over
    replicates.  (Our choice of method: the reference's interval comes from an R package whose method is not in the checkout.)
    """
    rows = object_weights(long, replicates, seed).select("b", "w", "n_i", F.inline("cells"))
    per = rows.groupBy("b", "score").agg(
        F.sum(F.col("w") * F.col("n_k") * (F.col("n_k") - 1)).alias("num"),
        F.sum(F.col("w") * F.col("n_k") * (F.col("n_i") - 1)).alias("den"))
    per = per.withColumn("a", F.col("num") / F.nullif(F.col("den"), F.lit(0)))
    lo, hi = (1 - level) / 2, (1 + level) / 2
    return per.groupBy("score").agg(
        F.round(F.percentile("a", F.lit(lo)), digits).alias("ci_low"),
        F.round(F.percentile("a", F.lit(hi)), digits).alias("ci_high"),
        F.count("a").alias("replicates"))
