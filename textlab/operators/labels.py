"""Label rounds: flatten annotation exports, correct, consolidate, attach.

Scale notes: every operator is a keyed aggregation or a key join.  Keep-last
uses ``max_by`` (partial aggregation, so a key holding a third of all rows is
combined map-side instead of sorted in one task); majority vote first counts
(id, label) pairs, so a window sees at most one row per distinct label of an
id.  Attaching label variants is one union + one keyed pivot + one join, not
one shuffled join per variant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The label vocabularies of the annotation exports.
CHOICE_TO_LABEL = {"yes": 1, "no": 0, "dfy": 1, "dfn": 0}


def choice_label(choice: Column) -> Column:
    """Map a choice string to 0/1; unknown or missing -> null."""
    expr = None
    for k, v in CHOICE_TO_LABEL.items():
        expr = (F.when(choice == k, F.lit(v)) if expr is None else expr.when(choice == k, F.lit(v)))
    return expr.otherwise(F.lit(None)).cast("bigint")


def annotation_labels(export: DataFrame, key: str = "id_hash", title: str = "title",
                      out_col: str = "label") -> DataFrame:
    """One row per annotation: (key, title, label) from a nested export.

    The first choice of the first result of each annotation decides the
    label; an empty choice list gives a null label.  An item without
    annotations (empty or null list) keeps one row with a null label.
    """
    ann = export.select(F.col("data").getField(key).alias(key),
                        F.col("data").getField(title).alias(title),
                        F.explode_outer("annotations").alias("_a"))
    first_choice = F.get(F.get(F.col("_a.result"), 0).getField("value").getField("choices"), 0)
    return ann.select(key, title, choice_label(first_choice).alias(out_col))


def dedupe_keep_max(df: DataFrame, key: str | Sequence[str], order: Column | str) -> DataFrame:
    """One row per key: the row with the largest ``order`` (must be unique per key)."""
    keys = [key] if isinstance(key, str) else list(key)
    order_col = F.col(order) if isinstance(order, str) else order
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order_col).alias("_row"))
    return picked.select(*keys, *[F.col("_row").getField(c).alias(c) for c in others])


def apply_corrections(round_df: DataFrame, truth: DataFrame, key: str = "id_hash",
                      label: str = "label", truth_label: str = "gt_label",
                      truth_order: str | None = None) -> DataFrame:
    """Left-join ground truth on the key; corrected label = coalesce(gt, label).

    Ground truth is reduced to one row per key first (the largest
    ``truth_order`` wins, else the largest label), so rows never multiply.
    """
    t = truth.select(key, F.col(truth_label).alias("_gt"),
                     *( [F.col(truth_order).alias("_o")] if truth_order else []))
    if truth_order:
        t = t.groupBy(key).agg(F.max_by("_gt", "_o").alias("_gt"))
    else:
        t = t.groupBy(key).agg(F.max("_gt").alias("_gt"))
    out = round_df.join(t, key, "left")
    return out.withColumn(label, F.coalesce(F.col("_gt"), F.col(label)).cast(
        round_df.schema[label].dataType)).drop("_gt")


def majority_label(rounds: DataFrame, key: str = "id_hash", label: str = "label",
                   out_col: str = "label") -> DataFrame:
    """Most frequent label per key; ties go to the larger label (positive)."""
    counts = rounds.filter(F.col(label).isNotNull()).groupBy(key, label).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(F.col("_n").desc(), F.col(label).desc())
    return (counts.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1")
            .select(key, F.col(label).alias(out_col)))


def unanimous_label(rounds: DataFrame, key: str = "id_hash", label: str = "label",
                    out_col: str = "label") -> DataFrame:
    """Keys whose non-null labels are all equal, with that label."""
    g = rounds.filter(F.col(label).isNotNull()).groupBy(key).agg(
        F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    return g.filter(F.col("_lo") == F.col("_hi")).select(key, F.col("_lo").alias(out_col))


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (must be empty for a key)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def override_union(frames: Sequence[DataFrame], key: str, seq_col: str | None = None) -> DataFrame:
    """Union frames (aligned by name on the first frame's columns); for each
    key keep the row from the latest frame (and, within a frame, the largest
    ``seq_col`` when given)."""
    cols = frames[0].columns
    parts = [f.select(*cols).withColumn("_prio", F.lit(i)) for i, f in enumerate(frames)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    order = F.struct("_prio", seq_col) if seq_col else F.col("_prio")
    return dedupe_keep_max(u.withColumn("_ord", order), key, "_ord").select(*cols)


def attach_label_variants(base: DataFrame, variants: Mapping[str, DataFrame], key: str = "id_hash",
                          label: str = "label") -> DataFrame:
    """Left-attach several (key, label) tables as columns ``label_<name>``.

    One union of all variants, one pivot keyed by ``key``, one left join.
    """
    names = list(variants)
    u = None
    for n in names:
        part = variants[n].select(key, F.lit(n).alias("_v"), F.col(label).alias("_l"))
        u = part if u is None else u.unionByName(part)
    wide = u.groupBy(key).pivot("_v", names).agg(F.first("_l"))
    wide = wide.select(key, *[F.col(n).alias(f"label_{n}") for n in names])
    return base.join(wide, key, "left")


def semi_filter(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids`` (membership as a semi join)."""
    return df.join(ids.select(key), key, "left_semi")
