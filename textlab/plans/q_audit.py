"""kNN-based audit queries on embeddings (Q1, Q2, Q4, Q5, V6).

The oracle SQL is brute force over all pairs (DuckDB only); the Spark side
never forms all pairs (see ``textlab.operators.knn``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions.hashing import h60_sql
from textlab.functions.tokens import tokens
from textlab.operators import audit as AU
from textlab.operators import knn as KN
from textlab.operators.features import tfidf
from textlab.operators.sparse_knn import sparse_knn
from textlab.plans.registry import register
from textlab.plans.views import LABELLED_SQL, hash_unit, hash_unit_sql, labelled_docs
from textlab.sources.tables import read_table

K = 10
EPS = 0.05
RANKS = KN.valuation_ranks(K, EPS)


def _pairs_sql(src: str, k: int) -> str:
    return f"""e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM {src}),
p AS (SELECT a.vec_id, b.vec_id AS neighbor_id,
             round(sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 9)
               AS distance
      FROM e a, e b WHERE a.vec_id <> b.vec_id),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank
                     FROM p) WHERE rank <= {k})"""


_SHAPLEY_SQL = f"""nb AS (SELECT r.vec_id AS t, r.neighbor_id, r.rank,
              CASE WHEN lt.label = ln.label THEN 1.0 ELSE 0.0 END AS m
       FROM {{source}} r JOIN l lt ON r.vec_id = lt.vec_id JOIN l ln ON r.neighbor_id = ln.vec_id),
st AS (SELECT *, lead(m) OVER (PARTITION BY t ORDER BY rank) AS mn FROM nb),
s2 AS (SELECT *, CASE WHEN mn IS NULL THEN CASE WHEN rank >= {RANKS} THEN 0 ELSE m / {K} * least({K}, rank) / rank END ELSE (m - mn) / {K} * least({K}, rank) / rank END AS step FROM st),
s3 AS (SELECT *, sum(step) OVER (PARTITION BY t ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS s
       FROM s2),
tot AS (SELECT neighbor_id, sum(s) AS s FROM s3 GROUP BY neighbor_id),
val AS (SELECT l.vec_id, l.label,
               round(coalesce(tot.s, 0), 9) + 0 AS value_sum,
               round(0.5 * (coalesce(tot.s, 0) / (SELECT count(*) FROM {{points}}) + 1), 9) AS data_valuation_score
        FROM l LEFT JOIN tot ON l.vec_id = tot.neighbor_id)"""

_VAL_SQL = "WITH " + _pairs_sql("embeddings", RANKS) + """,
l AS (SELECT vec_id, label FROM embeddings),
""" + _SHAPLEY_SQL.format(source="r", points="embeddings")


def _emb(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings")


def _val(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return KN.knn_shapley(e, KN.knn(e, "vec_id", "embedding", k=RANKS), "vec_id", "label", k=K, ranks=RANKS)


@register("knn", "WITH " + _pairs_sql("embeddings", K) + """
SELECT vec_id, neighbor_id, distance, CAST(rank AS INTEGER) AS rank FROM r""")
def q_knn(spark, sf_dir):
    return KN.knn(_emb(spark, sf_dir), "vec_id", "embedding", k=K)


@register("data_valuation", _VAL_SQL + " SELECT * FROM val")
def q_data_valuation(spark, sf_dir):
    return _val(spark, sf_dir)


@register("valuation_histogram", _VAL_SQL + """
SELECT label, CAST(greatest(least(floor((value_sum - CAST(-0.5 AS DOUBLE)) / CAST(0.1 AS DOUBLE)), 9), 0) AS INTEGER) AS bin, count(*) AS n
FROM val GROUP BY 1, 2""")
def q_valuation_histogram(spark, sf_dir):
    return AU.score_histogram(_val(spark, sf_dir), "value_sum", "label", -0.5, 0.5, 10)


# The same on text: TF-IDF rows of the labelled documents, words of two or more characters.
_WORDS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


def _text_pairs_sql(k: int) -> str:
    return "WITH " + LABELLED_SQL + f""",
docs AS (SELECT doc_id, label, list_filter({_WORDS_SQL}, lambda x: length(x) >= 2) AS tok FROM labelled),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tok) AS term FROM docs) GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1 + n) / (1 + df)) + 1) AS raw
        FROM tf JOIN dfs ON tf.term = dfs.term, (SELECT count(*) AS n FROM docs)),
w AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw),
p AS (SELECT a.doc_id, b.doc_id AS neighbor_id, round(least(sum(a.weight * b.weight), 1.0), 9) AS cosine
      FROM w a JOIN w b ON a.term = b.term WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, neighbor_id) AS rank FROM p) WHERE rank <= {k})"""


def _text_rows(spark, sf_dir):
    docs = labelled_docs(spark, sf_dir).select("doc_id", "label", F.filter(tokens("text"), lambda x: F.length(x) >= 2).alias("tokens"))
    return docs, tfidf(docs, "doc_id", "tokens", digits=None)


@register("knn_tfidf", _text_pairs_sql(K) + """
SELECT doc_id, neighbor_id, cosine, CAST(rank AS INTEGER) AS rank FROM r""")
def q_knn_tfidf(spark, sf_dir):
    return sparse_knn(_text_rows(spark, sf_dir)[1], "doc_id", K)


@register("data_valuation_tfidf", _text_pairs_sql(RANKS) + f""",
l AS (SELECT doc_id AS vec_id, label FROM docs), t AS (SELECT doc_id AS vec_id, neighbor_id, rank FROM r),
{_SHAPLEY_SQL.format(source="t", points="l")}
SELECT vec_id AS doc_id, label, value_sum, data_valuation_score FROM val""")
def q_data_valuation_tfidf(spark, sf_dir):
    docs, weights = _text_rows(spark, sf_dir)
    points = docs.select("doc_id", "label")
    return KN.knn_shapley(points, sparse_knn(weights, "doc_id", RANKS), "doc_id", "label", k=K, ranks=RANKS)


# Binary audit target on embeddings: y = (label = 1); oof p1 = 0.3 y + 0.7 u(vec_id).
def _oof(spark, sf_dir):
    e = _emb(spark, sf_dir).select("vec_id", (F.col("label") == 1).cast("int").alias("y"))
    return e.withColumn("p1", F.round(F.lit(0.3) * F.col("y") + F.lit(0.7) * hash_unit(F.col("vec_id")), 6))


_REVIEW_SQL = _VAL_SQL + f""",
oof AS (SELECT vec_id, CAST(label = 1 AS INTEGER) AS y,
               round(CAST(0.3 AS DOUBLE) * CAST(label = 1 AS INTEGER) + CAST(0.7 AS DOUBLE) * {hash_unit_sql('vec_id')}, 6)
                 AS p1 FROM embeddings),
b AS (SELECT vec_id, y, p1, CASE WHEN y = 1 THEN p1 ELSE 1 - p1 END AS label_quality,
             CAST(p1 >= 0.5 AS INTEGER) AS predicted_label FROM oof),
t AS (SELECT (SELECT avg(p1) FROM b WHERE y = 1) AS t1, (SELECT avg(1 - p1) FROM b WHERE y = 0) AS t0),
c AS (SELECT b.*, CASE WHEN p1 >= t1 AND 1 - p1 >= t0 THEN CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END
                       WHEN p1 >= t1 THEN 1 WHEN 1 - p1 >= t0 THEN 0 END AS conf FROM b, t),
j AS (SELECT y, count(*) AS n, sum(CASE WHEN conf IS NOT NULL THEN 1 ELSE 0 END) AS c_all,
             sum(CASE WHEN conf IS NOT NULL AND conf <> y THEN 1 ELSE 0 END) AS c_off FROM c GROUP BY y),
k AS (SELECT y, CAST(round(c_off / nullif(c_all, 0) * n) AS BIGINT) AS k FROM j),
rr AS (SELECT b.*, row_number() OVER (PARTITION BY y ORDER BY
        -(CASE WHEN y = 1 THEN 1 - p1 - p1 ELSE p1 - (1 - p1) END), vec_id) AS rk FROM b),
issues AS (SELECT rr.vec_id, rr.y, round(rr.label_quality, 6) AS label_quality, rr.predicted_label,
                  rk <= coalesce(k.k, 0) AS is_label_issue FROM rr LEFT JOIN k ON rr.y = k.y)"""


def _issues(spark, sf_dir):
    return AU.label_issues(_oof(spark, sf_dir), "vec_id", "y", "p1")


@register("review_queue", _REVIEW_SQL + """
SELECT coalesce(i.vec_id, v.vec_id) AS vec_id, i.y, i.label_quality, i.predicted_label, i.is_label_issue,
       v.data_valuation_score, v.data_valuation_score < 0.5 AS is_detrimental, i.predicted_label <> i.y AS label_mismatch
FROM issues i FULL JOIN (SELECT vec_id, data_valuation_score FROM val) v ON i.vec_id = v.vec_id
WHERE coalesce(i.is_label_issue, false) OR coalesce(v.data_valuation_score < 0.5, false)""")
def q_review_queue(spark, sf_dir):
    q = AU.review_queue(_issues(spark, sf_dir), _val(spark, sf_dir), "vec_id", "y")
    return q.select("vec_id", "y", "label_quality", "predicted_label", "is_label_issue", "data_valuation_score",
                    "is_detrimental", "label_mismatch")


@register("issue_overlap", _REVIEW_SQL + """,
a AS (SELECT vec_id FROM issues WHERE is_label_issue),
bb AS (SELECT vec_id FROM val WHERE data_valuation_score < 0.5)
SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM bb) AS n_b,
       (SELECT count(*) FROM (SELECT vec_id FROM a INTERSECT SELECT vec_id FROM bb)) AS n_intersection,
       (SELECT count(*) FROM (SELECT vec_id FROM a UNION SELECT vec_id FROM bb)) AS n_union""")
def q_issue_overlap(spark, sf_dir):
    a = _issues(spark, sf_dir).filter("is_label_issue")
    b = _val(spark, sf_dir).filter(F.col("data_valuation_score") < 0.5)
    return AU.issue_overlap(a, b, "vec_id")


_SMOTE_SQL = f"""WITH mino AS (SELECT * FROM embeddings WHERE label = 1),
{_pairs_sql('mino', 5)},
cnt AS (SELECT (SELECT count(*) FROM embeddings WHERE label <> 1) AS other, (SELECT count(*) FROM mino) AS m),
base AS (SELECT vec_id, row_number() OVER (ORDER BY {h60_sql("'42:' || CAST(vec_id AS VARCHAR)")}, vec_id) AS rk
         FROM mino),
gen AS (SELECT base.vec_id, CAST(rk - 1 + i * m AS BIGINT) AS synthetic_id FROM base, cnt,
               (SELECT unnest(range(0, 100000)) AS i) g
        WHERE rk - 1 + i * m < greatest(other - m, 0)),
h AS (SELECT *, CAST(({h60_sql("'42:' || CAST(synthetic_id AS VARCHAR) || ':nn'")} % 5) + 1 AS INTEGER) AS nr,
             {h60_sql("'42:' || CAST(synthetic_id AS VARCHAR) || ':u'")} / {float(1 << 60)} AS u FROM gen)
SELECT h.synthetic_id, h.vec_id AS base_id, r.neighbor_id,
       list_transform(list_zip(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])),
                      lambda z: round(z[1] + u * (z[2] - z[1]), 6)) AS vector
FROM h JOIN r ON h.vec_id = r.vec_id AND h.nr = r.rank
JOIN mino x ON x.vec_id = h.vec_id JOIN mino y ON y.vec_id = r.neighbor_id"""


@register("smote", _SMOTE_SQL)
def q_smote(spark, sf_dir):
    return KN.smote(_emb(spark, sf_dir), "vec_id", "embedding", "label", minority=1, k=5, seed=42)
