"""Flagship slice: tokens -> n-grams -> vocabulary -> rules -> scoring -> metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions.tokens import tokens
from textlab.operators import rules as R
from textlab.plans.registry import register
from textlab.plans.views import labelled_docs

# The reference's rule-baseline settings.
MIN_DF, MAX_FEATURES, THRESHOLD, NGRAMS = 3, 1000, 0.94, (1, 2)

_TOKENS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"

def rules_sql(text_expr: str = "text") -> str:
    """CTEs docs .. rules of the rule miner over ``text_expr`` (columns of
    documents plus ``label``)."""
    tok = f"regexp_extract_all(lower(coalesce({text_expr}, '')), '[\\p{{L}}\\p{{N}}]+')"
    return f"""WITH labelled AS (
  SELECT d.*, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
docs AS (SELECT doc_id, label, {tok} AS tok FROM labelled),
grams AS (
  SELECT doc_id, label,
         tok || list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1]) AS g
  FROM docs),
occ AS (SELECT label, unnest(g) AS term, 1 AS o, 0 AS d FROM grams
        UNION ALL
        SELECT label, unnest(list_distinct(g)) AS term, 0 AS o, 1 AS d FROM grams),
stats AS (SELECT label, term, sum(o) AS total, sum(d) AS df FROM occ GROUP BY label, term),
ranked AS (SELECT label, term, total,
                  row_number() OVER (PARTITION BY label ORDER BY total DESC, term) AS rk
           FROM stats WHERE df >= {MIN_DF}),
vocab AS (SELECT * FROM ranked WHERE rk <= {MAX_FEATURES}),
scored AS (
  SELECT p.term AS pattern, CAST(p.total AS BIGINT) AS pos, CAST(coalesce(n.total, 0) AS BIGINT) AS neg,
         p.total / (p.total + coalesce(n.total, 0) + 1) AS score
  FROM vocab p LEFT JOIN (SELECT term, total FROM vocab WHERE label = 0) n ON p.term = n.term
  WHERE p.label = 1 AND p.total > 0),
rules AS (
  SELECT row_number() OVER (ORDER BY score DESC, pos DESC, pattern) AS rank, pattern, pos, neg,
         round(score, 6) AS score
  FROM scored WHERE score > {THRESHOLD})"""


_RULES_SQL = rules_sql("text")

BASELINE_TAIL = """,
arr AS (SELECT coalesce(list(pattern ORDER BY rank), []::VARCHAR[]) AS r FROM rules),
pred AS (SELECT label, CAST(coalesce(list_bool_or(list_transform(arr.r,
           lambda x: instr(array_to_string(tok, ' '), x) > 0)), false) AS INTEGER) AS pred
         FROM docs, arr),
c AS (SELECT count(*) AS n,
             CAST(sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM pred)
SELECT n, tp, fp, fn, tn,
       round(coalesce((tp + tn) / nullif(n, 0), 0), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       (SELECT count(*) FROM rules) AS num_rules
FROM c"""


def _docs(spark, sf_dir):
    return labelled_docs(spark, sf_dir).select("doc_id", "label", tokens("text").alias("tokens"))


def _mine(docs):
    return R.mine_rules(docs, "label", "tokens", min_df=MIN_DF, max_features=MAX_FEATURES,
                        threshold=THRESHOLD, ngram_range=NGRAMS)


@register("mine_rules", _RULES_SQL + "\nSELECT rank, pattern, pos, neg, score FROM rules")
def q_mine_rules(spark, sf_dir):
    return _mine(_docs(spark, sf_dir))


@register("rule_predict", _RULES_SQL + """,
arr AS (SELECT coalesce(list(pattern ORDER BY rank), []::VARCHAR[]) AS r FROM rules),
txt AS (SELECT doc_id, label, array_to_string(tok, ' ') AS t FROM docs)
SELECT doc_id, label,
       CAST(coalesce(list_bool_or(list_transform(arr.r, lambda x: instr(t, x) > 0)), false) AS INTEGER) AS pred,
       list_filter(arr.r, lambda x: instr(t, x) > 0)[1] AS matched_rule
FROM txt, arr""")
def q_rule_predict(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return R.predict_rules(docs, _mine(docs)).select("doc_id", "label", "pred", "matched_rule")


@register("rule_baseline", _RULES_SQL + BASELINE_TAIL)
def q_rule_baseline(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return R.rule_baseline(docs, "label", "tokens", min_df=MIN_DF, max_features=MAX_FEATURES,
                           threshold=THRESHOLD, ngram_range=NGRAMS)
