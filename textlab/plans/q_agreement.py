"""Inter-coder agreement queries over the derived rating table."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.operators import agreement as A
from textlab.functions.hashing import unit_sql
from textlab.plans.registry import register
from textlab.plans.views import RATINGS_SQL, WIDE_SQL, ratings, title_col, title_sql
from textlab.sources.tables import read_table

_W = "WITH " + RATINGS_SQL + ",\n" + WIDE_SQL


def _wide(spark, sf_dir):
    return A.ratings_wide(ratings(spark, sf_dir), [1, 2, 3])


@register("ratings_long", "WITH " + RATINGS_SQL + " SELECT rater, object_id, score FROM ratings")
def q_ratings_long(spark, sf_dir):
    return ratings(spark, sf_dir)


@register("ratings_wide", _W + " SELECT object_id, coder_1, coder_2, coder_3 FROM wide")
def q_ratings_wide(spark, sf_dir):
    return _wide(spark, sf_dir)


@register("percent_agreement", _W + """
SELECT CAST(sum(CASE WHEN coder_1 = coder_2 THEN 1 ELSE 0 END) AS BIGINT) AS n_equal,
       count(*) AS n_total,
       round(sum(CASE WHEN coder_1 = coder_2 THEN 1 ELSE 0 END) * 100.0 / nullif(count(*), 0), 6) AS percent
FROM wide""")
def q_percent_agreement(spark, sf_dir):
    return A.percent_agreement(_wide(spark, sf_dir), "coder_1", "coder_2")


@register("cohen_kappa", _W + """,
m AS (SELECT count(*) AS n,
             sum(CASE WHEN coder_1 = coder_2 THEN 1 ELSE 0 END) / count(*) AS po FROM wide),
k AS (SELECT k, sum(ca) AS ca, sum(cb) AS cb FROM (
        SELECT coder_1 AS k, 1 AS ca, 0 AS cb FROM wide UNION ALL SELECT coder_2, 0, 1 FROM wide)
      GROUP BY k),
e AS (SELECT sum(ca * cb) / ((SELECT n FROM m) * (SELECT n FROM m)) AS pe FROM k)
SELECT CAST(n AS BIGINT) AS n, round(po, 9) AS po, round(pe, 9) AS pe,
       round((po - pe) / nullif(1 - pe, 0), 9) AS kappa FROM m, e""")
def q_cohen_kappa(spark, sf_dir):
    return A.cohen_kappa(_wide(spark, sf_dir), "coder_1", "coder_2")


_CAT_SQL = """,
obj AS (SELECT object_id, count(*) AS n_i FROM r GROUP BY object_id),
cat AS (SELECT object_id, score, count(*) AS n_k FROM r GROUP BY object_id, score)
SELECT cat.score, round(sum(n_k * (n_k - 1)) / nullif(sum(n_k * (n_i - 1)), 0), 9) AS agreement
FROM cat JOIN obj USING (object_id) WHERE n_i >= 2 GROUP BY cat.score"""


@register("category_agreement", "WITH " + RATINGS_SQL + """,
r AS (SELECT * FROM ratings WHERE rater IN (1, 2) AND score IS NOT NULL)""" + _CAT_SQL)
def q_category_agreement(spark, sf_dir):
    return A.category_agreement(ratings(spark, sf_dir).filter(F.col("rater").isin(1, 2)))


@register("category_agreement_3", "WITH " + RATINGS_SQL + """,
r AS (SELECT * FROM ratings WHERE score IS NOT NULL)""" + _CAT_SQL)
def q_category_agreement_3(spark, sf_dir):
    return A.category_agreement(ratings(spark, sf_dir))


@register("fleiss_kappa", "WITH " + RATINGS_SQL + """,
r AS (SELECT * FROM ratings WHERE score IS NOT NULL),
obj AS (SELECT object_id, count(*) AS n_i FROM r GROUP BY object_id),
cat AS (SELECT object_id, score, count(*) AS n_k FROM r GROUP BY object_id, score),
c AS (SELECT * FROM cat JOIN obj USING (object_id) WHERE n_i >= 2),
po AS (SELECT object_id, sum(n_k * (n_k - 1)) / (first(n_i) * (first(n_i) - 1)) AS p_i FROM c GROUP BY object_id),
pb AS (SELECT avg(p_i) AS p_bar, count(*) AS n_objects FROM po),
pe AS (SELECT sum(nk * nk) / (sum(nk) * sum(nk)) AS p_e FROM (SELECT score, sum(n_k) AS nk FROM c GROUP BY score))
SELECT CAST(n_objects AS BIGINT) AS n_objects, round(p_bar, 9) AS p_bar, round(p_e, 9) AS p_e,
       round((p_bar - p_e) / (1 - p_e), 9) AS kappa FROM pb, pe""")
def q_fleiss_kappa(spark, sf_dir):
    return A.fleiss_kappa(ratings(spark, sf_dir))


@register("mean_pairwise_agreement", _W + """,
p AS (SELECT ((CASE WHEN coder_1 = coder_2 THEN 1.0 ELSE 0.0 END) + (CASE WHEN coder_1 = coder_3 THEN 1.0 ELSE 0.0 END)
              + (CASE WHEN coder_2 = coder_3 THEN 1.0 ELSE 0.0 END))::DOUBLE / 3 * 100 AS pct FROM wide)
SELECT round(avg(round(pct, 2)), 6) AS rounded, round(avg(pct), 6) AS exact FROM p""")
def q_mean_pairwise_agreement(spark, sf_dir):
    return A.mean_pairwise_agreement(_wide(spark, sf_dir), ["coder_1", "coder_2", "coder_3"])


@register("coder_discrepancies", _W + f"""
SELECT w.object_id, substr({title_sql('d.text')}, 1, 60) AS title, w.coder_3 AS expert, w.coder_1 AS coders
FROM wide w JOIN documents d ON d.doc_id = w.object_id
WHERE w.coder_1 = w.coder_2 AND w.coder_1 <> w.coder_3""")
def q_coder_discrepancies(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", spread=False).select(
        F.col("doc_id").alias("object_id"), title_col("text").alias("_title"))
    wide = _wide(spark, sf_dir).join(docs, "object_id")
    return A.discrepancies(wide, "coder_1", "coder_2", "coder_3", F.col("_title"))


@register("coder_vs_expert", "WITH " + RATINGS_SQL + """,
j AS (SELECT c.rater, c.score AS pred, t.score AS truth FROM ratings c
      JOIN ratings t ON c.object_id = t.object_id AND t.rater = 3 WHERE c.rater <> 3),
c AS (SELECT rater, count(*) AS n,
             CAST(sum(CASE WHEN truth = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN truth = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN truth = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN truth = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM j GROUP BY rater),
m AS (SELECT rater, n, tp, fp, fn, tn, coalesce((tp + tn) / nullif(n, 0), 0) AS accuracy,
             coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c)
SELECT rater, n, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, round(avg(accuracy), 6), round(avg(precision), 6), round(avg(recall), 6),
       round(avg(f1), 6) FROM m""")
def q_coder_vs_expert(spark, sf_dir):
    return A.coder_vs_expert(ratings(spark, sf_dir), expert=3)


def _poisson_sql(u: str) -> str:
    cases = " ".join(f"WHEN {u} < {c!r} THEN {k}" for k, c in enumerate(A.POISSON1_CDF))
    return f"CASE {cases} ELSE {len(A.POISSON1_CDF)} END"


@register("category_agreement_ci", "WITH " + RATINGS_SQL + f""",
r AS (SELECT * FROM ratings WHERE score IS NOT NULL),
obj AS (SELECT object_id, count(*) AS n_i FROM r GROUP BY object_id),
cat AS (SELECT object_id, score, count(*) AS n_k FROM r GROUP BY object_id, score),
c AS (SELECT * FROM cat JOIN obj USING (object_id) WHERE n_i >= 2),
cb AS (SELECT c.*, b FROM c, (SELECT unnest(range(1, 201)) AS b) bb),
cw AS (SELECT *, {_poisson_sql(unit_sql("'42:' || CAST(b AS VARCHAR) || ':' || CAST(object_id AS VARCHAR)"))} AS w FROM cb),
per AS (SELECT b, score, sum(w * n_k * (n_k - 1)) / nullif(sum(w * n_k * (n_i - 1)), 0) AS a FROM cw GROUP BY b, score)
SELECT score, round(quantile_cont(a, 0.025), 6) AS ci_low, round(quantile_cont(a, 0.975), 6) AS ci_high,
       count(a) AS replicates
FROM per GROUP BY score""")
def q_category_agreement_ci(spark, sf_dir):
    return A.category_agreement_ci(ratings(spark, sf_dir), replicates=200, level=0.95, seed=42)
