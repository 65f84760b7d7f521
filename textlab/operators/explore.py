"""Exploration and QA aggregates: one pass each, conditional sums + stack.

The reference scans the data once per column (QA) or once per pattern and
dataset (coverage); here every report is a single aggregation per input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _stack(pairs: Sequence[tuple[str, Sequence[str]]], names: Sequence[str]) -> Column:
    """stack(n, 'k1', a1, b1, 'k2', a2, b2, ...) AS (names...)."""
    args = ", ".join(f"'{k}', " + ", ".join(f"`{c}`" for c in cols) for k, cols in pairs)
    return F.expr(f"stack({len(pairs)}, {args}) AS ({', '.join(names)})")


def text_quality_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null, n_empty) for each text column, from one aggregation."""
    aggs = []
    for c in columns:
        aggs.append(F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(f"{c}__null"))
        aggs.append(F.sum((F.col(c) == "").cast("int")).cast("bigint").alias(f"{c}__empty"))
    wide = df.agg(*aggs)
    return wide.select(_stack([(c, [f"{c}__null", f"{c}__empty"]) for c in columns],
                              ["column", "n_null", "n_empty"]))


def section_patterns(text: Column, a: str, b: str, c: str, d: str) -> dict[str, Column]:
    """The reference's five formats + unknown: both a and b; a only; b only;
    contains c; contains d; none of these."""
    has = {k: text.contains(v) for k, v in {"a": a, "b": b, "c": c, "d": d}.items()}
    pats = {
        "both": has["a"] & has["b"],
        "a_only": has["a"] & ~has["b"],
        "b_only": has["b"] & ~has["a"],
        "c": has["c"],
        "d": has["d"],
    }
    anyp = None
    for v in pats.values():
        anyp = v if anyp is None else (anyp | v)
    pats["unknown"] = ~anyp
    return pats


def pattern_coverage(datasets: Mapping[str, DataFrame], patterns_of, digits: int = 6) -> DataFrame:
    """(pattern, <ds>_n, <ds>_total, <ds>_share ...): one aggregation per dataset.

    ``patterns_of(df)`` returns {pattern name: boolean column} for that frame.
    """
    out = None
    for ds, df in datasets.items():
        pats = patterns_of(df)
        names = list(pats)
        agg = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.sum(v.cast("int")).cast("bigint").alias(f"_p{i}") for i, v in enumerate(pats.values())])
        long = agg.select(F.col("_total"), _stack([(n, [f"_p{i}"]) for i, n in enumerate(names)], ["pattern", "_n"]))
        long = long.select("pattern", F.col("_n").alias(f"{ds}_n"), F.col("_total").alias(f"{ds}_total"),
                           F.round(F.col("_n") / F.nullif(F.col("_total"), F.lit(0)), digits).alias(f"{ds}_share"))
        out = long if out is None else out.join(long, "pattern")
    return out


def value_counts(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """(value, n, percent) with percent of all rows rounded to ``digits``."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # Window over the (few) distinct values only, after aggregation.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(col, "n", F.round(F.col("n") * 100.0 / total, digits).alias("percent"))


def category_counts(df: DataFrame, list_col: str, missing: str = "Missing") -> DataFrame:
    """Counts per list element; a null or empty list counts once as ``missing``."""
    el = df.select(F.explode_outer(list_col).alias("category"))
    return el.select(F.coalesce("category", F.lit(missing)).alias("category")).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label_cols: Sequence[str], digits: int = 6) -> DataFrame:
    """(task, n_pos, n_neg, minority_ratio) per 0/1 label column, one pass."""
    aggs = []
    for c in label_cols:
        aggs += [F.sum((F.col(c) == 1).cast("int")).cast("bigint").alias(f"{c}__pos"),
                 F.sum((F.col(c) == 0).cast("int")).cast("bigint").alias(f"{c}__neg")]
    long = df.agg(*aggs).select(_stack([(c, [f"{c}__pos", f"{c}__neg"]) for c in label_cols],
                                       ["task", "n_pos", "n_neg"]))
    ratio = F.least("n_pos", "n_neg") / F.nullif(F.greatest("n_pos", "n_neg"), F.lit(0))
    return long.select("task", "n_pos", "n_neg", F.round(ratio, digits).alias("minority_ratio"))
