"""Paraphrase augmentation rounds.

The rewrite itself is a user function (a remote model in the reference);
Spark partitions the rows, calls it per Arrow batch in ``mapInPandas``,
checks quality with a user scorer (at most ``max_attempts`` tries per row,
rows that never reach ``threshold`` are dropped) and carries the label by
column.  Round r rewrites the rows produced by round r-1; every round is
checkpointed so lineage does not grow with the number of rounds.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators.corpus import restore_metadata, split_metadata
from textlab.operators.splits import shuffle_order
from textlab.session import checkpoint_dir

Rewriter = Callable[[pd.Series, int], pd.Series]      # (texts, attempt) -> rewritten texts
Scorer = Callable[[pd.Series, pd.Series], pd.Series]  # (originals, rewrites) -> scores in [0, 1]


def word_overlap_score(orig: pd.Series, new: pd.Series) -> pd.Series:
    """A simple scorer: Jaccard overlap of lower-cased word sets."""
    def j(a, b):
        sa, sb = set(str(a).lower().split()), set(str(b).lower().split())
        return len(sa & sb) / len(sa | sb) if (sa or sb) else 1.0
    return pd.Series([j(a, b) for a, b in zip(orig, new)], index=orig.index, dtype="float64")


def drop_every_fourth(texts: pd.Series, attempt: int) -> pd.Series:
    """Deterministic stand-in rewriter: drops every fourth word (offset by
    the attempt number)."""
    def rw(t):
        ws = str(t).split(" ")
        return " ".join(w for i, w in enumerate(ws) if (i + attempt) % 4 != 0)
    return texts.map(rw)


# Rows rewritten at a time: a batch may bring thousands of long texts.
REWRITE_ROWS = 256


def _rewrite_partition(rewriter: Rewriter, scorer: Scorer, threshold: float, max_attempts: int):
    def run(batches):
        for pdf in (batch.iloc[at:at + REWRITE_ROWS] for batch in batches for at in range(0, len(batch), REWRITE_ROWS)):
            src = pdf["_src"]
            # With a metadata block the rewrite must keep "title: desc";
            # one without a colon is a failed attempt.
            needs_colon = pdf["_meta"].fillna("") != ""
            out = pd.Series([None] * len(pdf), index=pdf.index, dtype="object")
            todo = pd.Series(True, index=pdf.index)
            for attempt in range(max_attempts):
                if not todo.any():
                    break
                cand = rewriter(src[todo], attempt)
                ok = (scorer(src[todo], cand) >= threshold) & (~needs_colon[todo] | cand.str.contains(":", regex=False))
                acc = ok[ok].index
                out.loc[acc] = cand.loc[acc]
                todo.loc[acc] = False
            keep = out.notna()
            res = pdf.loc[keep].drop(columns=["_src"]).copy()
            res["_new"] = out[keep].astype(str)
            yield res
    return run


def augment_rounds(base: DataFrame, id_col: str, text_col: str, label_col: str, rounds: int = 1,
                   rewriter: Rewriter = drop_every_fourth, scorer: Scorer = word_overlap_score,
                   threshold: float = 0.7, max_attempts: int = 3, keep_metadata: bool = True,
                   seed: int = 42) -> DataFrame:
    """base (round 0) plus ``rounds`` rewrite rounds, shuffled by ``seed``.

    Columns: id, label, text, round, parent_round, position.
    """
    spark = base.sparkSession
    checkpoint_dir(spark)
    cur = base.select(id_col, label_col, text_col).withColumn("round", F.lit(0)).withColumn(
        "parent_round", F.lit(None).cast("int"))
    all_rows = cur
    for r in range(1, rounds + 1):
        parts = split_metadata(text_col) if keep_metadata else {"to_rewrite": F.col(text_col), "meta": F.lit("")}
        prep = cur.select(id_col, label_col, F.col("round").alias("parent_round"),
                          parts["to_rewrite"].alias("_src"), parts["meta"].alias("_meta"))
        schema = f"{id_col} {base.schema[id_col].dataType.simpleString()}, " \
                 f"{label_col} {base.schema[label_col].dataType.simpleString()}, parent_round int, " \
                 f"_meta string, _new string"
        rewritten = prep.mapInPandas(_rewrite_partition(rewriter, scorer, threshold, max_attempts), schema)
        nxt = rewritten.select(id_col, label_col, restore_metadata("_new", "_meta").alias(text_col),
                               F.lit(r).alias("round"), "parent_round")
        nxt = nxt.checkpoint(eager=True)
        all_rows = all_rows.unionByName(nxt)
        cur = nxt
    keyed = all_rows.withColumn("_key", F.concat_ws("#", F.col(id_col).cast("string"), F.col("round").cast("string")))
    return shuffle_order(keyed, "_key", seed).drop("_key")


def augment_folds(docs: DataFrame, folds: DataFrame, id_col: str, text_col: str, label_col: str,
                  factor: int = 2, **kw) -> DataFrame:
    """P5: augment only the training side of each fold (``factor - 1``
    rounds).  Each distinct training document is rewritten once and joined
    back to every fold that trains on it; test rows are untouched, so no
    test document is ever a parent in its own fold."""
    train_ids = folds.filter(F.col("role") == "train").select(id_col).distinct()
    pool = docs.join(train_ids, id_col, "left_semi")
    aug = augment_rounds(pool, id_col, text_col, label_col, rounds=factor - 1, **kw).filter(F.col("round") > 0)
    aug = aug.select(id_col, "round", F.col(text_col).alias("_aug"))
    f = folds.select("fold", id_col, "role")
    base = f.join(docs.select(id_col, label_col, text_col), id_col).withColumn("round", F.lit(0))
    extra = f.filter(F.col("role") == "train").join(aug, id_col).join(docs.select(id_col, label_col), id_col)
    extra = extra.select("fold", id_col, "role", label_col, F.col("_aug").alias(text_col), "round")
    return base.select("fold", id_col, "role", label_col, text_col, "round").unionByName(extra)
