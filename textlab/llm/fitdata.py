"""Bounded training samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def sample_labels(labels: DataFrame, label: str, exclude: Column, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``per_class`` labelled ids of each class (0 and 1), the smallest by a hash of the id.

    ``exclude`` marks the ids that must not be learnt from.  Ids that are null, excluded, without a label, or labelled
    both 0 and 1 in repeated rows are left out.  The result has columns ``_id`` and ``_y`` and at most ``2 * per_class``
    rows, which bounds what a join against it broadcasts.
    """
    one = (labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"), exclude.alias("_out"))
           .where(F.col("_id").isNotNull() & ~F.coalesce(F.col("_out"), F.lit(True)) & F.col("_y").isin(0, 1))
           .groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_y1"))
           .where("_y = _y1").select("_id", "_y"))
    order = F.xxhash64(F.col("_id"), F.lit(17))
    picks = [one.where(F.col("_y") == c).orderBy(order, "_id").limit(per_class) for c in (0, 1)]
    return picks[0].union(picks[1])
