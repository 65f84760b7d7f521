"""Exploration queries: distributions, category counts, pattern coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.operators import explore as X
from textlab.plans.registry import register
from textlab.plans.views import CATEGORIES_SQL, categories_col
from textlab.sources.tables import read_table


@register("label_distribution", """
SELECT quality AS label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percent
FROM labels GROUP BY quality""")
def q_label_distribution(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select(F.col("quality").alias("label"))
    return X.value_counts(lab, "label")


@register("category_counts", f"""
SELECT coalesce(c, 'Missing') AS category, count(*) AS n FROM (
  SELECT unnest(CASE WHEN len(cats) > 0 THEN cats ELSE [NULL::VARCHAR] END) AS c
  FROM (SELECT {CATEGORIES_SQL} AS cats FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1))
GROUP BY 1""")
def q_category_counts(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    pos = read_table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return X.category_counts(d.join(pos, "doc_id").select(categories_col().alias("cats")), "cats")


# Markers that occur in the driver's documents, in the reference's
# two-heading structure (a and b, a only, b only, c, d, none).
_MARKERS = ("License", "the ", "@", "|")


def _pattern_sql(alias):
    a, b, c, d = _MARKERS
    ha, hb, hc, hd = (f"contains(text, '{m}')" for m in (a, b, c, d))
    pats = {"both": f"{ha} AND {hb}", "a_only": f"{ha} AND NOT {hb}", "b_only": f"{hb} AND NOT {ha}",
            "c": hc, "d": hd}
    pats["unknown"] = "NOT (" + " OR ".join(f"({v})" for v in pats.values()) + ")"
    return "\nUNION ALL\n".join(
        f"SELECT '{k}' AS pattern, CAST(sum(CASE WHEN {v} THEN 1 ELSE 0 END) AS BIGINT) AS {alias}_n, "
        f"count(*) AS {alias}_total FROM {alias}_src" for k, v in pats.items())


@register("section_patterns", f"""
WITH labelled_src AS (SELECT d.text FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
all_src AS (SELECT text FROM documents),
lp AS ({_pattern_sql('labelled')}),
ap AS ({_pattern_sql('all')})
SELECT lp.pattern, labelled_n, labelled_total, round(labelled_n / nullif(labelled_total, 0), 6) AS labelled_share,
       all_n, all_total, round(all_n / nullif(all_total, 0), 6) AS all_share
FROM lp JOIN ap ON lp.pattern = ap.pattern""")
def q_section_patterns(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id")
    return X.pattern_coverage({"labelled": d.join(lab, "doc_id"), "all": d},
                              lambda df: X.section_patterns(F.col("text"), *_MARKERS))


@register("class_balance", """
SELECT task, n_pos, n_neg, round(least(n_pos, n_neg) / nullif(greatest(n_pos, n_neg), 0), 6) AS minority_ratio
FROM (
SELECT 'quality' AS task, CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg FROM labels
UNION ALL
SELECT 'toxic', CAST(sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS BIGINT),
       CAST(sum(CASE WHEN toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM labels)""")
def q_class_balance(spark, sf_dir):
    return X.class_balance(read_table(spark, sf_dir, "labels"), ["quality", "toxic"])
