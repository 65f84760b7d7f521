"""Label pipeline queries: flatten, correct, consolidate, override, attach."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.operators import labels as L
from textlab.plans.registry import register
from textlab.plans.views import EXPORT_SQL, RATINGS_SQL, annotation_export, ratings
from textlab.sources.tables import read_table


@register("annotation_flatten", "WITH " + EXPORT_SQL + """,
anns AS (SELECT data.id_hash AS id_hash, data.title AS title,
                unnest(CASE WHEN len(annotations) > 0 THEN annotations ELSE [NULL] END) AS a FROM export)
SELECT id_hash, title,
       CAST(CASE a.result[1].value.choices[1] WHEN 'yes' THEN 1 WHEN 'no' THEN 0
            WHEN 'dfy' THEN 1 WHEN 'dfn' THEN 0 END AS BIGINT) AS label
FROM anns""")
def q_annotation_flatten(spark, sf_dir):
    return L.annotation_labels(annotation_export(spark, sf_dir))


def _round(spark, sf_dir, rater):
    return ratings(spark, sf_dir).filter(F.col("rater") == rater).select(
        "object_id", F.col("score").alias("label"))


@register("apply_corrections", "WITH " + RATINGS_SQL + """,
gt AS (SELECT doc_id, max(quality) AS gt_label FROM labels WHERE toxic = 1 GROUP BY doc_id)
SELECT r.object_id, CAST(coalesce(gt.gt_label, r.score) AS INTEGER) AS label
FROM ratings r LEFT JOIN gt ON r.object_id = gt.doc_id
WHERE r.rater = 1""")
def q_apply_corrections(spark, sf_dir):
    truth = read_table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select(
        F.col("doc_id").alias("object_id"), F.col("quality").alias("gt_label"))
    return L.apply_corrections(_round(spark, sf_dir, 1), truth, key="object_id")


@register("label_majority", "WITH " + RATINGS_SQL + """,
c AS (SELECT object_id, score, count(*) AS n FROM ratings WHERE score IS NOT NULL GROUP BY object_id, score),
r AS (SELECT object_id, score,
             row_number() OVER (PARTITION BY object_id ORDER BY n DESC, score DESC) AS rk FROM c)
SELECT object_id, score AS label FROM r WHERE rk = 1""")
def q_label_majority(spark, sf_dir):
    return L.majority_label(ratings(spark, sf_dir), "object_id", "score", "label")


@register("label_unanimous", "WITH " + RATINGS_SQL + """
SELECT object_id, min(score) AS label FROM ratings WHERE score IS NOT NULL
GROUP BY object_id HAVING min(score) = max(score)""")
def q_label_unanimous(spark, sf_dir):
    return L.unanimous_label(ratings(spark, sf_dir), "object_id", "score", "label")


@register("duplicate_keys", """
SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    return L.duplicate_keys(read_table(spark, sf_dir, "conversations").select("conv_id"), "conv_id")


@register("override_labels", """
WITH u AS (SELECT doc_id, quality AS label, 0 AS prio FROM labels
           UNION ALL SELECT doc_id, 1, 1 FROM labels WHERE toxic = 1),
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY prio DESC) AS rk FROM u)
SELECT doc_id, label FROM r WHERE rk = 1""")
def q_override_labels(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    base = lab.select("doc_id", F.col("quality").alias("label"))
    manual = lab.filter(F.col("toxic") == 1).select("doc_id", F.lit(1).alias("label"))
    return L.override_union([base, manual], "doc_id")


@register("override_union", """
WITH u AS (SELECT doc_id, lang, source, 0 AS prio FROM documents
           UNION ALL SELECT doc_id, lang, source || '-new', 1 FROM documents WHERE lang = 'de'),
r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY doc_id ORDER BY prio DESC) AS rk FROM u)
SELECT doc_id, lang, source FROM r WHERE rk = 1""")
def q_override_union(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", spread=False)
    legacy = docs.select("doc_id", "lang", "source")
    # The newer dump has another column order and an extra column.
    remote = docs.filter(F.col("lang") == "de").select(
        "n_chars", F.concat("source", F.lit("-new")).alias("source"), "lang", "doc_id")
    return L.override_union([legacy, remote], "doc_id")


@register("attach_label_variants", "WITH " + RATINGS_SQL + """,
c AS (SELECT object_id, score, count(*) AS n FROM ratings WHERE score IS NOT NULL GROUP BY object_id, score),
maj AS (SELECT object_id, score AS label FROM (SELECT object_id, score,
          row_number() OVER (PARTITION BY object_id ORDER BY n DESC, score DESC) AS rk FROM c) WHERE rk = 1),
eq AS (SELECT object_id, min(score) AS label FROM ratings WHERE score IS NOT NULL
       GROUP BY object_id HAVING min(score) = max(score)),
orig AS (SELECT object_id, score AS label FROM ratings WHERE rater = 3)
SELECT d.doc_id, maj.label AS label_majority, eq.label AS label_equal, orig.label AS label_original
FROM documents d
LEFT JOIN maj ON d.doc_id = maj.object_id
LEFT JOIN eq ON d.doc_id = eq.object_id
LEFT JOIN orig ON d.doc_id = orig.object_id""")
def q_attach_label_variants(spark, sf_dir):
    r = ratings(spark, sf_dir)
    variants = {
        "majority": L.majority_label(r, "object_id", "score", "label"),
        "equal": L.unanimous_label(r, "object_id", "score", "label"),
        "original": r.filter(F.col("rater") == 3).select("object_id", F.col("score").alias("label")),
    }
    variants = {k: v.withColumnRenamed("object_id", "doc_id") for k, v in variants.items()}
    base = read_table(spark, sf_dir, "documents", spread=False).select("doc_id")
    return L.attach_label_variants(base, variants, key="doc_id")


@register("membership_semi", """
SELECT doc_id, lang, source FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def q_membership_semi(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "lang", "source")
    ids = read_table(spark, sf_dir, "labels").filter(F.col("quality") == 1)
    return L.semi_filter(docs, ids, "doc_id")


@register("labelled_only", "WITH " + RATINGS_SQL + """,
eq AS (SELECT object_id, min(score) AS label FROM ratings WHERE score IS NOT NULL
       GROUP BY object_id HAVING min(score) = max(score))
SELECT d.doc_id, eq.label AS label_equal FROM documents d LEFT JOIN eq ON d.doc_id = eq.object_id
WHERE eq.label IS NOT NULL""")
def q_labelled_only(spark, sf_dir):
    # rows whose label (here the unanimous variant) is null are dropped.
    r = ratings(spark, sf_dir)
    eq = L.unanimous_label(r, "object_id", "score", "label").withColumnRenamed("object_id", "doc_id")
    base = read_table(spark, sf_dir, "documents", spread=False).select("doc_id")
    out = L.attach_label_variants(base, {"equal": eq}, key="doc_id")
    return out.dropna(subset=["label_equal"])


@register("id_search", """
SELECT doc_id, lang, source FROM documents WHERE contains(CAST(doc_id AS VARCHAR), '42')""")
def q_id_search(spark, sf_dir):
    # substring search on an identifier.
    d = read_table(spark, sf_dir, "documents", spread=False).select("doc_id", "lang", "source")
    return d.filter(F.col("doc_id").cast("string").contains("42"))
