"""Splits, resampling and evaluation queries (V1-V3, V7, V8, V10, V11, W5,
G8, M2, M3, M5, M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textlab.functions.hashing import h60_sql
from textlab.functions.metrics import binary_metrics
from textlab.operators import evaluate as E
from textlab.operators import splits as SP
from textlab.plans.registry import register
from textlab.plans.views import hash_unit, hash_unit_sql
from textlab.sources.tables import read_table

SEED = 42


def _labels(spark, sf_dir):
    return read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")


# Fixed derivation of a model probability: 0.55 * label + 0.45 * u(doc_id).
def _scored(spark, sf_dir):
    lab = _labels(spark, sf_dir)
    return lab.withColumn("p1", F.round(F.lit(0.55) * F.col("label") + F.lit(0.45) * hash_unit(F.col("doc_id")), 6))


_SCORED_SQL = f"""scored AS (SELECT doc_id, quality AS label, toxic,
  round(0.55 * quality + 0.45 * {hash_unit_sql('doc_id')}, 6) AS p1 FROM labels)"""


def _quota_sql(group: str, total: str) -> str:
    """Largest-remainder quotas over a table c(group..., label, n_c)."""
    gp = f"PARTITION BY {group}" if group else ""
    return f"""q0 AS (SELECT *, sum(n_c) OVER ({gp}) AS n_all FROM c),
q1 AS (SELECT *, {total.format(n='n_all')} AS t FROM q0),
q2 AS (SELECT *, t * n_c / n_all AS share FROM q1),
q3 AS (SELECT *, floor(share) AS fl, share - floor(share) AS rem FROM q2),
q4 AS (SELECT *, t - sum(fl) OVER ({gp}) AS lft,
              row_number() OVER ({gp} ORDER BY rem DESC, label ASC) AS rr FROM q3),
quota AS (SELECT {group + ',' if group else ''} label, CAST(fl + CASE WHEN rr <= lft THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q4)"""


@register("stratified_splits", f"""
WITH base AS (SELECT f.fold, l.doc_id, l.quality AS label,
                     {h60_sql("'42:' || CAST(f.fold AS VARCHAR) || ':' || CAST(l.doc_id AS VARCHAR)")} AS h
              FROM labels l, (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS fold) f),
c AS (SELECT fold, label, count(*) AS n_c FROM base GROUP BY fold, label),
{_quota_sql('fold', 'ceil(0.3 * {n})')},
r AS (SELECT *, row_number() OVER (PARTITION BY fold, label ORDER BY h, doc_id) AS rk FROM base)
SELECT r.fold, r.doc_id, r.label, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS role
FROM r JOIN quota USING (fold, label)""")
def q_stratified_splits(spark, sf_dir):
    return SP.stratified_splits(_labels(spark, sf_dir), "doc_id", "label", 10, 0.3, SEED)


@register("stratified_kfold", f"""
SELECT doc_id, label, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM (
  SELECT doc_id, quality AS label, row_number() OVER (PARTITION BY quality ORDER BY
         {h60_sql("'42:' || CAST(doc_id AS VARCHAR)")}, doc_id) AS rk FROM labels)""")
def q_stratified_kfold(spark, sf_dir):
    return SP.stratified_kfold(_labels(spark, sf_dir), "doc_id", "label", 5, SEED)


@register("holdout_split", f"""
SELECT doc_id, label, toxic, position,
       CASE WHEN position <= floor(0.7 * (SELECT count(*) FROM labels)) THEN 'test' ELSE 'train' END AS role
FROM (SELECT doc_id, quality AS label, toxic, row_number() OVER (ORDER BY
         {h60_sql("'42:' || CAST(doc_id AS VARCHAR)")}, doc_id) AS position FROM labels)""")
def q_holdout_split(spark, sf_dir):
    return SP.holdout_split(_labels(spark, sf_dir), "doc_id", 0.7, SEED).select(
        "doc_id", "label", "toxic", "position", "role")


@register("undersample", f"""
WITH r AS (SELECT doc_id, quality AS label, toxic, row_number() OVER (PARTITION BY quality ORDER BY
             {h60_sql("'42:' || CAST(doc_id AS VARCHAR)")}, doc_id) AS rk FROM labels)
SELECT doc_id, label, toxic FROM r
WHERE rk <= (SELECT min(c) FROM (SELECT count(*) AS c FROM labels GROUP BY quality))""")
def q_undersample(spark, sf_dir):
    return SP.undersample(_labels(spark, sf_dir), "doc_id", "label", SEED)


@register("oversample", f"""
WITH c AS (SELECT quality, count(*) AS nc FROM labels GROUP BY quality),
m AS (SELECT max(nc) AS big FROM c),
r AS (SELECT l.doc_id, l.quality AS label, l.toxic, c.nc, row_number() OVER (PARTITION BY l.quality ORDER BY
             {h60_sql("'42:' || CAST(l.doc_id AS VARCHAR)")}, l.doc_id) AS rk
      FROM labels l JOIN c ON l.quality = c.quality)
SELECT doc_id, label, toxic, CAST(unnest(range(1, CAST(floor(big / nc) + CASE WHEN rk <= big % nc THEN 1 ELSE 0 END AS BIGINT) + 1)) AS INTEGER) AS replica
FROM r, m""")
def q_oversample(spark, sf_dir):
    return SP.oversample(_labels(spark, sf_dir), "doc_id", "label", SEED)


@register("shuffle_order", f"""
SELECT doc_id, label, toxic, row_number() OVER (ORDER BY {h60_sql("'42:' || CAST(doc_id AS VARCHAR)")}, doc_id)
       AS position FROM (SELECT doc_id, quality AS label, toxic FROM labels)""")
def q_shuffle_order(spark, sf_dir):
    return SP.shuffle_order(_labels(spark, sf_dir), "doc_id", SEED)


@register("apply_threshold", "WITH " + _SCORED_SQL + """
SELECT doc_id, label, p1, CAST(p1 >= 0.6 AS INTEGER) AS pred FROM scored""")
def q_apply_threshold(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("doc_id", "label", "p1", E.apply_threshold(F.col("p1"), 0.6).alias("pred"))


_METRICS_SQL = """
       round(coalesce((tp + tn) / nullif(n, 0), 0), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"""


def _confusion_sql(truth: str, pred: str) -> str:
    return f"""count(*) AS n,
       CAST(sum(CASE WHEN {truth} = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
       CAST(sum(CASE WHEN {truth} = 0 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN {truth} = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN {truth} = 0 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn"""


@register("binary_metrics", "WITH " + _SCORED_SQL + f"""
SELECT n, tp, fp, fn, tn, {_METRICS_SQL} FROM (
  SELECT {_confusion_sql('label', 'CAST(p1 >= 0.5 AS INTEGER)')} FROM scored)""")
def q_binary_metrics(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("pred", E.apply_threshold(F.col("p1"), 0.5))
    return binary_metrics(s, "label", "pred")


_FOLD_METRICS_SQL = f"""fm AS (
  SELECT fold, n, tp, fp, fn, tn, {_METRICS_SQL} FROM (
    SELECT fold, {_confusion_sql('label', 'CAST(p1 >= 0.5 AS INTEGER)')}
    FROM (SELECT doc_id, quality AS label, CAST(doc_id % 10 AS INTEGER) AS fold,
                 round(0.55 * quality + 0.45 * {hash_unit_sql('doc_id')}, 6) AS p1 FROM labels)
    GROUP BY fold))"""


def _fold_metrics(spark, sf_dir):
    # Ten folds by doc_id % 10: every row is scored once (a partition, not a filter).
    s = _scored(spark, sf_dir).withColumn("fold", (F.col("doc_id") % 10).cast("int"))
    s = s.withColumn("pred", E.apply_threshold(F.col("p1"), 0.5))
    return binary_metrics(s, "label", "pred", ["fold"])


@register("fold_summary", "WITH " + _FOLD_METRICS_SQL + """
SELECT count(*) AS n_folds, """ + ", ".join(
    f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std_pop, "
    f"round(stddev_samp({m}), 6) AS {m}_std_samp" for m in ("f1", "accuracy", "precision", "recall")) + " FROM fm")
def q_fold_summary(spark, sf_dir):
    return E.fold_summary(_fold_metrics(spark, sf_dir))


@register("recall_first_objective", "WITH " + _FOLD_METRICS_SQL + """,
s AS (SELECT avg(recall) AS r, avg(precision) AS p FROM fm)
SELECT round(r, 6) AS recall_mean, round(p, 6) AS precision_mean,
       round(0.3 * r + 0.7 * p - 2.0 * greatest(0.0, 0.95 - r), 6) AS objective FROM s""")
def q_recall_first_objective(spark, sf_dir):
    s = _fold_metrics(spark, sf_dir).agg(F.avg("recall").alias("r"), F.avg("precision").alias("p"))
    return s.select(F.round("r", 6).alias("recall_mean"), F.round("p", 6).alias("precision_mean"),
                    F.round(E.recall_first_objective(F.col("r"), F.col("p")), 6).alias("objective"))


_SWEEP_SQL = "WITH " + _SCORED_SQL + f""",
grid AS (SELECT i, round(CAST(0.1 AS DOUBLE) + i * CAST(0.01 AS DOUBLE), 10) AS threshold FROM (SELECT unnest(range(0, 36)) AS i)),
c AS (SELECT g.threshold, {_confusion_sql('s.label', 'CAST(s.p1 >= g.threshold AS INTEGER)')}
      FROM grid g, scored s GROUP BY g.threshold),
sweep AS (SELECT threshold, n, tp, fp, fn, tn, {_METRICS_SQL} FROM c),
sw AS (SELECT *, round(0.3 * recall + 0.7 * precision - 2.0 * greatest(0.0, 0.95 - recall), 6) AS objective
       FROM sweep)"""


def _sweep(spark, sf_dir):
    return E.threshold_sweep(_scored(spark, sf_dir), "p1", "label", 0.1, 0.45, 0.01)


@register("threshold_sweep", _SWEEP_SQL + " SELECT * FROM sw")
def q_threshold_sweep(spark, sf_dir):
    return _sweep(spark, sf_dir)


@register("threshold_choice", _SWEEP_SQL + """
SELECT * FROM sw ORDER BY CASE WHEN recall >= 0.95 THEN 1 ELSE 0 END DESC,
  CASE WHEN recall >= 0.95 THEN precision ELSE recall END DESC, precision DESC, threshold DESC LIMIT 1""")
def q_threshold_choice(spark, sf_dir):
    return E.choose_threshold(_sweep(spark, sf_dir), 0.95)


@register("focal_loss", "WITH " + _SCORED_SQL + """,
pc AS (SELECT label, least(greatest(p1, 1e-12), 1 - 1e-12) AS p FROM scored),
pt AS (SELECT label, CASE WHEN label = 1 THEN p ELSE 1 - p END AS pt FROM pc)
SELECT round(avg((CASE WHEN label = 1 THEN 0.25 ELSE 0.75 END) * pow(1 - pt, 2.0) * -ln(pt)), 9) AS focal_mean,
       round(sum((CASE WHEN label = 1 THEN 0.25 ELSE 0.75 END) * pow(1 - pt, 2.0) * -ln(pt)), 9) AS focal_sum,
       round(avg(-ln(pt)), 9) AS bce_mean FROM pt""")
def q_focal_loss(spark, sf_dir):
    s = _scored(spark, sf_dir)
    fl = E.focal_loss(F.col("p1"), F.col("label"), 0.25, 2.0)
    bce = E.focal_loss(F.col("p1"), F.col("label"), None, 0.0)
    return s.agg(F.round(F.avg(fl), 9).alias("focal_mean"), F.round(F.sum(fl), 9).alias("focal_sum"),
                 F.round(F.avg(bce), 9).alias("bce_mean"))


@register("class_weights", """
WITH c AS (SELECT toxic AS label, count(*) AS n FROM labels GROUP BY toxic)
SELECT label, n, CASE WHEN label = (SELECT label FROM c ORDER BY n, label LIMIT 1) THEN CAST(2.0 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS weight
FROM c""")
def q_class_weights(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select(F.col("toxic").alias("label"))
    return E.class_weights(lab, "label", 2.0)


# External predictions: free-text answers derived from the toxic flag, with
# an unparsable answer for every ninth document (a value, not a filter).
_EXT_SQL = """ext AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'n/a' ELSE ' ' || CAST(toxic AS VARCHAR) END
                 AS prediction FROM labels)"""


@register("evaluate_external", "WITH " + _EXT_SQL + f""",
j AS (SELECT l.quality AS y, TRY_CAST(trim(e.prediction) AS INTEGER) AS p FROM labels l LEFT JOIN ext e ON l.doc_id = e.doc_id),
k AS (SELECT y, p IN (0, 1) AS ok, CASE WHEN p IN (0, 1) THEN p ELSE 0 END AS pred FROM j)
SELECT n, n_unparsable, tp, fp, fn, tn, {_METRICS_SQL} FROM (
  SELECT CAST(sum(CASE WHEN coalesce(ok, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_unparsable,
         {_confusion_sql('y', 'pred')} FROM k)""")
def q_evaluate_external(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    ext = lab.select("doc_id", F.when(F.col("doc_id") % 9 == 0, F.lit("n/a"))
                     .otherwise(F.concat(F.lit(" "), F.col("toxic").cast("string"))).alias("prediction"))
    return E.evaluate_external(lab.select("doc_id", F.col("quality").alias("label")), ext, "doc_id")


@register("holdout_split_mlm", f"""
SELECT doc_id, position,
       CASE WHEN position <= floor(0.2 * (SELECT count(*) FROM documents)) THEN 'test' ELSE 'train' END AS role
FROM (SELECT doc_id, row_number() OVER (ORDER BY
         {h60_sql("'42:' || CAST(doc_id AS VARCHAR)")}, doc_id) AS position FROM documents)""")
def q_holdout_split_mlm(spark, sf_dir):
    # V4: the masked-LM corpus split, 20 % held out, seeded.
    d = read_table(spark, sf_dir, "documents", spread=False).select("doc_id")
    return SP.holdout_split(d, "doc_id", 0.2, SEED).select("doc_id", "position", "role")
