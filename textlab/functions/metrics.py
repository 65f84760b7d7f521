"""Binary classification metrics as aggregate expressions.

All ratios follow ``zero_division=0``: an empty denominator gives 0.0, never
an ANSI division error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _safe_div(num: Column, den: Column) -> Column:
    return F.coalesce(num / F.nullif(den, F.lit(0)), F.lit(0.0))


def confusion_aggs(truth: str = "label", pred: str = "pred") -> list[Column]:
    t, p = F.col(truth), F.col(pred)
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when((t == 1) & (p == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when((t == 0) & (p == 1), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when((t == 1) & (p == 0), 1).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when((t == 0) & (p == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
    ]


def metric_columns(digits: int | None = 6) -> list[Column]:
    """accuracy/precision/recall/f1 from columns n, tp, fp, fn, tn."""
    tp, fp, fn, n = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "n"))
    tn = F.col("tn").cast("double")
    acc = _safe_div(tp + tn, n)
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    out = {"accuracy": acc, "precision": prec, "recall": rec, "f1": f1}
    if digits is not None:
        out = {k: F.round(v, digits) for k, v in out.items()}
    return [v.alias(k) for k, v in out.items()]


def binary_metrics(df, truth: str = "label", pred: str = "pred",
                   group_cols: list[str] | tuple = (), digits: int | None = 6):
    """One row per group: n, tp, fp, fn, tn, accuracy, precision, recall, f1."""
    g = list(group_cols)
    agg = df.groupBy(*g).agg(*confusion_aggs(truth, pred))
    return agg.select(*g, "n", "tp", "fp", "fn", "tn", *metric_columns(digits))
