"""Reporting queries (R1-R5) and top-k tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions import text as T
from textlab.functions.hashing import h60_sql
from textlab.functions.tokens import tokens
from textlab.operators import report as RP
from textlab.operators import rules as R
from textlab.plans import sqltext as S
from textlab.plans.q_rules import BASELINE_TAIL, MAX_FEATURES, MIN_DF, NGRAMS, THRESHOLD, _RULES_SQL, rules_sql
from textlab.plans.q_splits import _SWEEP_SQL, _sweep
from textlab.plans.registry import register
from textlab.plans.views import CATEGORIES_SQL, categories_col, labelled_docs, title_col, title_sql
from textlab.sources.tables import read_table

_KW = dict(min_df=MIN_DF, max_features=MAX_FEATURES, threshold=THRESHOLD, ngram_range=NGRAMS)

# Text variants compared by the experiment runner.
_VARIANTS_SQL = {
    "description_text_only": "text",
    "description_title_cats_compact": S.title_cats_compact(
        title_sql(), S.list_join(CATEGORIES_SQL), "coalesce(source, '')", "text"),
    "description_title_cats_compact_wo_section_stopwords": S.title_cats_compact_wo_sections(
        title_sql(), S.list_join(CATEGORIES_SQL), "coalesce(source, '')", "text"),
}


def _variant_cols():
    area, app = T.list_join(categories_col()), F.coalesce("source", F.lit(""))
    return {"description_text_only": F.col("text"),
            "description_title_cats_compact": T.title_cats_compact(title_col(), area, app, "text"),
            "description_title_cats_compact_wo_section_stopwords":
                T.title_cats_compact_wo_sections(title_col(), area, app, "text")}


@register("variant_comparison", "SELECT *, row_number() OVER (ORDER BY f1 DESC, text_col) AS rank FROM (\n" +
          "\nUNION ALL\n".join(f"SELECT *, '{name}' AS text_col FROM ({rules_sql(expr)}{BASELINE_TAIL})"
                               for name, expr in _VARIANTS_SQL.items()) + ")")
def q_variant_comparison(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    j = d.join(lab, "doc_id")
    variants = {name: tokens(c) for name, c in _variant_cols().items()}
    out = RP.compare_variants_at_once(j, variants, **_KW)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register("top_rules", _RULES_SQL + "\nSELECT rank, pattern, score FROM rules WHERE rank <= 10")
def q_top_rules(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text").alias("tokens"))
    rules = R.mine_rules(docs, "label", "tokens", **_KW)
    return rules.filter(F.col("rank") <= 10).select("rank", "pattern", "score")


@register("top_results", _SWEEP_SQL + "\nSELECT threshold, f1, precision, recall, accuracy FROM sw "
          "ORDER BY f1 DESC, threshold LIMIT 5")
def q_top_results(spark, sf_dir):
    return _sweep(spark, sf_dir).orderBy(F.col("f1").desc(), "threshold").limit(5).select(
        "threshold", "f1", "precision", "recall", "accuracy")


_TOK = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


@register("next_round_sample", _RULES_SQL + f""",
arr AS (SELECT coalesce(list(pattern ORDER BY rank), []::VARCHAR[]) AS r FROM rules),
cand AS (SELECT doc_id, array_to_string({_TOK}, ' ') AS t FROM documents
         WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
p AS (SELECT doc_id, CAST(coalesce(list_bool_or(list_transform(arr.r, lambda x: instr(t, x) > 0)), false) AS INTEGER)
        AS pred FROM cand, arr),
pos AS (SELECT doc_id, pred, 'predicted_positive' AS stratum FROM p WHERE pred = 1),
neg AS (SELECT doc_id, pred, 'sampled_negative' AS stratum FROM (
          SELECT *, row_number() OVER (ORDER BY {h60_sql("'42:' || CAST(doc_id AS VARCHAR)")}, doc_id) AS rk
          FROM p WHERE pred = 0) WHERE rk <= (SELECT count(*) FROM pos))
SELECT * FROM pos UNION ALL SELECT * FROM neg""")
def q_next_round_sample(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text").alias("tokens"))
    rules = R.mine_rules(docs, "label", "tokens", **_KW)
    lab = read_table(spark, sf_dir, "labels").select("doc_id")
    cand = read_table(spark, sf_dir, "documents").join(lab, "doc_id", "left_anti").select(
        "doc_id", tokens("text").alias("tokens"))
    pred = R.predict_rules(cand, rules, explain_col=None).select("doc_id", "pred")
    return RP.next_round_sample(pred, "doc_id", "pred", 42)


_CENTROID_SQL = """c AS (SELECT list(v ORDER BY i) AS c FROM (
  SELECT i, avg(v) AS v FROM (SELECT unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS v
                              FROM embeddings WHERE label = 1) GROUP BY i)),
s AS (SELECT e.vec_id, e.label, round(list_dot_product(CAST(e.embedding AS DOUBLE[]), c.c)
        / nullif(sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))
                 * sqrt(list_dot_product(c.c, c.c)), 0), 6) AS score
      FROM embeddings e, c WHERE e.label <> 1)"""


def _semantic(spark, sf_dir, most):
    e = read_table(spark, sf_dir, "embeddings")
    q = RP.centroid(e.filter(F.col("label") == 1), "embedding")
    return RP.cosine_rank(e.filter(F.col("label") != 1), "embedding", q, "vec_id", 20, most).select(
        "vec_id", "label", "score")


@register("semantic_topk", "WITH " + _CENTROID_SQL + " SELECT vec_id, label, score FROM s ORDER BY score DESC, vec_id LIMIT 20")
def q_semantic_topk(spark, sf_dir):
    return _semantic(spark, sf_dir, True)


@register("semantic_bottomk", "WITH " + _CENTROID_SQL + " SELECT vec_id, label, score FROM s ORDER BY score, vec_id LIMIT 20")
def q_semantic_bottomk(spark, sf_dir):
    return _semantic(spark, sf_dir, False)
