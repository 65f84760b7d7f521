"""Features and audit queries: term statistics, vocabulary, TF-IDF, label issues."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions.tokens import tokens
from textlab.operators import audit as AU
from textlab.operators.features import term_stats, tfidf, vocabulary
from textlab.plans.registry import register
from textlab.plans.views import LABELLED_SQL, hash_unit, hash_unit_sql, labelled_docs
from textlab.sources.tables import read_table

_TOK = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"

_STATS_SQL = f"""stats AS (
  SELECT term, CAST(sum(o) AS BIGINT) AS total, CAST(sum(d) AS BIGINT) AS df FROM (
    SELECT unnest(tok) AS term, 1 AS o, 0 AS d FROM docs
    UNION ALL SELECT unnest(list_distinct(tok)) AS term, 0 AS o, 1 AS d FROM docs)
  GROUP BY term)"""


def _ldocs(spark, sf_dir):
    return labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text").alias("tokens"))


@register("term_counts", "WITH " + LABELLED_SQL + f""",
docs AS (SELECT doc_id, {_TOK} AS tok FROM labelled),
{_STATS_SQL}
SELECT term, total, df FROM stats""")
def q_term_counts(spark, sf_dir):
    return term_stats(_ldocs(spark, sf_dir), "tokens")


@register("vocabulary", "WITH " + LABELLED_SQL + f""",
docs AS (SELECT doc_id, {_TOK} AS tok FROM labelled),
{_STATS_SQL}
SELECT term, total, df FROM stats WHERE df >= 2 ORDER BY total DESC, term LIMIT 500""")
def q_vocabulary(spark, sf_dir):
    return vocabulary(term_stats(_ldocs(spark, sf_dir), "tokens"), min_df=2, max_features=500)


@register("tfidf", f"""
WITH docs AS (SELECT doc_id, {_TOK} AS tok FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tok) AS term FROM docs) GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf, dfs.df, tf.tf * (ln((1 + n.n) / (1 + dfs.df)) + 1) AS raw
      FROM tf JOIN dfs ON tf.term = dfs.term, n)
SELECT doc_id, term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df,
       round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", tokens("text").alias("tokens"))
    return tfidf(docs, "doc_id", "tokens")


# Out-of-sample probability stand-in for the audit: 0.3 * label + 0.7 * u.
def _oof(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return lab.withColumn("p1", F.round(F.lit(0.3) * F.col("label") + F.lit(0.7) * hash_unit(F.col("doc_id")), 6))


_OOF_SQL = f"""oof AS (SELECT doc_id, quality AS label,
  round(CAST(0.3 AS DOUBLE) * quality + CAST(0.7 AS DOUBLE) * {hash_unit_sql('doc_id')}, 6) AS p1 FROM labels)"""

_ISSUES_SQL = "WITH " + _OOF_SQL + """,
b AS (SELECT doc_id, label, p1, CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END AS label_quality,
             CAST(p1 >= 0.5 AS INTEGER) AS predicted_label FROM oof),
t AS (SELECT (SELECT avg(p1) FROM b WHERE label = 1) AS t1, (SELECT avg(1 - p1) FROM b WHERE label = 0) AS t0),
c AS (SELECT b.*, CASE WHEN p1 >= t1 AND 1 - p1 >= t0 THEN CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END
                       WHEN p1 >= t1 THEN 1 WHEN 1 - p1 >= t0 THEN 0 END AS conf FROM b, t),
j AS (SELECT label, count(*) AS n, sum(CASE WHEN conf IS NOT NULL THEN 1 ELSE 0 END) AS c_all,
             sum(CASE WHEN conf IS NOT NULL AND conf <> label THEN 1 ELSE 0 END) AS c_off FROM c GROUP BY label),
k AS (SELECT label, CAST(round(c_off / nullif(c_all, 0) * n) AS BIGINT) AS k FROM j),
r AS (SELECT b.*, row_number() OVER (PARTITION BY label ORDER BY
        -(CASE WHEN label = 1 THEN 1 - p1 - p1 ELSE p1 - (1 - p1) END), doc_id) AS rk FROM b),
issues AS (SELECT r.doc_id, r.label, round(r.label_quality, 6) AS label_quality, r.predicted_label,
                  rk <= coalesce(k.k, 0) AS is_label_issue FROM r LEFT JOIN k ON r.label = k.label)"""


@register("label_issues", _ISSUES_SQL + " SELECT * FROM issues")
def q_label_issues(spark, sf_dir):
    return AU.label_issues(_oof(spark, sf_dir))


@register("worst_quality", _ISSUES_SQL + """
SELECT doc_id, label, label_quality, predicted_label FROM issues ORDER BY label_quality, doc_id LIMIT 20""")
def q_worst_quality(spark, sf_dir):
    iss = AU.label_quality(_oof(spark, sf_dir))
    return iss.orderBy("label_quality", "doc_id").limit(20).select("doc_id", "label", "label_quality",
                                                                    "predicted_label")


@register("quality_histogram", _ISSUES_SQL + """
SELECT label, CAST(least(floor(label_quality / 0.1), 9) AS INTEGER) AS bin, count(*) AS n FROM issues GROUP BY 1, 2""")
def q_quality_histogram(spark, sf_dir):
    return AU.score_histogram(AU.label_quality(_oof(spark, sf_dir)), "label_quality", "label", 0.0, 1.0, 10)
