"""Term statistics, vocabularies and TF-IDF in long (sparse) form.

Scale notes
-----------
* ``term_stats`` explodes each row once into (term, occurrence, first-in-doc)
  structs, so total count and document frequency come out of a single
  aggregation with map-side combine: one shuffle keyed by (group, term) whose
  size is bounded by partitions x vocabulary, however hot a term is.
* Vocabularies are top-k cuts; the per-class variant uses one
  ``orderBy().limit()`` per class (partial top-k in every task, then a merge of
  k rows per task), never a window that funnels a whole class into one task.
* TF-IDF stays sparse (doc, term, tf, weight).  Term frequencies are counted
  inside each row (sorted tokens, run boundaries, run lengths), so no shuffle
  is needed for them; the document-frequency side of the join is small after
  aggregation and AQE turns it into a broadcast when its measured size
  allows, a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.functions.tokens import ngrams


def term_stats(docs: DataFrame, tokens_col: str = "tokens",
               group_cols: Sequence[str] = (), n_min: int = 1,
               n_max: int = 1) -> DataFrame:
    """(group..., term, total, df): occurrences and documents per term.

    Each document contributes one (term, count) row per distinct term,
    counted inside the row; one aggregation (map-side combined) sums them.
    """
    g = list(group_cols)
    grams = docs.select(*g, ngrams(tokens_col, n_min, n_max).alias("_g"))
    runs = term_freqs(grams, g, "_g")
    return runs.groupBy(*g, "term").agg(
        F.sum("tf").cast("bigint").alias("total"),
        F.count(F.lit(1)).cast("bigint").alias("df"),
    )


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: partial top-k per task)."""
    return df.orderBy(*order).limit(k)


def vocabulary(stats: DataFrame, min_df: int = 1, max_features: int | None = None,
               class_col: str | None = None, classes: Sequence = (0, 1)) -> DataFrame:
    """Terms with df >= min_df, then the max_features most frequent.

    Ties on the total count are broken by term ascending.  With ``class_col``
    the cut is made within each class (one bounded top-k per class value).
    """
    kept = stats.filter(F.col("df") >= min_df)
    order = [F.col("total").desc(), F.col("term").asc()]
    if max_features is None:
        return kept
    if class_col is None:
        return top_k(kept, max_features, order)
    parts = [top_k(kept.filter(F.col(class_col) == F.lit(c)), max_features, order) for c in classes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def term_freqs(docs: DataFrame, id_col: str | Sequence[str] = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(keys..., term, tf) counted inside each row: sort the tokens, mark where
    a run of equal tokens starts, emit (token, run length) -- no shuffle.  Null tokens count for nothing.

    ``sort_array`` compares natively; ``array_sort`` would call a lambda for every comparison."""
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    s = docs.select(*keys, F.sort_array(tokens_col).alias("_s"))
    srt = F.col("_s")
    n = F.size(srt)
    starts = F.when(n > 0, F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | ~(
        F.element_at(srt, i).eqNullSafe(F.element_at(srt, i - 1))))).otherwise(F.array().cast("array<int>"))
    s = s.withColumn("_b", starts)
    b = F.col("_b")
    runs = F.transform(b, lambda x, j: F.struct(F.element_at(srt, x).alias("term"),
                                                (F.coalesce(F.try_element_at(b, j + 2), n + 1) - x).alias("tf")))
    return s.select(*keys, F.inline(runs)).filter(F.col("term").isNotNull())


def tfidf(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens",
          min_df: int = 1, digits: int | None = 6) -> DataFrame:
    """Smooth TF-IDF, L2-normalised per document, long form.

    idf = ln((1 + n) / (1 + df)) + 1 with n the number of documents;
    weight = tf * idf / ||tf * idf||_2 over the document's kept terms.
    """
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    tf = term_freqs(docs, id_col, tokens_col)
    dfs = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    joined = tf.join(dfs, "term")
    w = F.col("tf") * (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + F.lit(1.0))
    joined = joined.withColumn("raw", w)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    out = joined.withColumn("weight", F.col("raw") / norm)
    if digits is not None:
        out = out.withColumn("weight", F.round("weight", digits))
    return out.select(id_col, "term", F.col("tf").cast("bigint").alias("tf"),
                      F.col("df").cast("bigint").alias("df"), "weight")


def idf_table(docs: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens",
              min_df: int = 1) -> DataFrame:
    """(term, df, idf) fitted on ``docs``: idf = ln((1 + n) / (1 + df)) + 1."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    dfs = (docs.select(id_col, F.explode(F.array_distinct(tokens_col)).alias("term"))
           .groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df))
    return dfs.withColumn("idf", F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + F.lit(1.0))


def tfidf_apply(docs: DataFrame, idf: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(doc, term, tf, weight) of any documents with a fitted idf table;
    terms outside the table are dropped; L2-normalised per document."""
    tf = term_freqs(docs, id_col, tokens_col)
    j = tf.join(idf.select("term", "idf"), "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return j.select(id_col, "term", F.col("tf").cast("bigint").alias("tf"), (F.col("raw") / norm).alias("weight"))
