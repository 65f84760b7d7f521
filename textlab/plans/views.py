"""Derived inputs shared by the Spark builders and the oracle SQL.

Each derived view is written twice, once with the DataFrame API and once as a
DuckDB CTE; both must give identical rows.  All of them read whole tables.

Fixed derivations (stand-ins for the reference's inputs):
* labelled documents: documents JOIN labels on doc_id; label = quality.
* title: first line of the text.
* list column ``categories``: NULL when doc_id % 5 = 0, [] when 1, else
  [lang, source].
* raters: rater 3 = quality; rater 1 = quality flipped when doc_id % 11 = 0;
  rater 2 = toxic when doc_id % 7 = 0, else quality.
* p1 (a model probability): 0.55 * label + 0.45 * u, u = first 8 hex digits of
  md5(doc_id) / 2^32, rounded to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.sources.tables import read_table


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")
    return d.join(lab, "doc_id")


LABELLED_SQL = """labelled AS (
  SELECT d.doc_id, d.text, l.quality AS label, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def hash_unit(key) -> F.Column:
    """Deterministic u in [0, 1) from md5 of a string key (same in DuckDB)."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_unit_sql(key_sql: str) -> str:
    return f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rating table (rater int, object_id bigint, score int) from labels."""
    from textlab.operators.agreement import ratings_long
    lab = read_table(spark, sf_dir, "labels")
    wide = lab.select(
        "doc_id",
        F.when(F.col("doc_id") % 11 == 0, F.lit(1) - F.col("quality")).otherwise(F.col("quality")).alias("coder_1"),
        F.when(F.col("doc_id") % 7 == 0, F.col("toxic")).otherwise(F.col("quality")).alias("coder_2"),
        F.col("quality").alias("coder_3"))
    return ratings_long(wide, "doc_id", ["coder_1", "coder_2", "coder_3"])


RATINGS_SQL = """ratings AS (
  SELECT 1 AS rater, doc_id AS object_id,
         CASE WHEN doc_id % 11 = 0 THEN 1 - quality ELSE quality END AS score FROM labels
  UNION ALL
  SELECT 2, doc_id, CASE WHEN doc_id % 7 = 0 THEN toxic ELSE quality END FROM labels
  UNION ALL
  SELECT 3, doc_id, quality FROM labels)"""

WIDE_SQL = """wide AS (
  SELECT * FROM (
    SELECT object_id,
           max(score) FILTER (WHERE rater = 1) AS coder_1,
           max(score) FILTER (WHERE rater = 2) AS coder_2,
           max(score) FILTER (WHERE rater = 3) AS coder_3
    FROM ratings GROUP BY object_id)
  WHERE coder_1 IS NOT NULL AND coder_2 IS NOT NULL AND coder_3 IS NOT NULL)"""


def annotation_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested export (data struct, annotations array) built from labels.

    choices: [] when doc_id % 13 = 0; dfy/dfn when doc_id % 4 = 0; else
    yes/no.  Toxic documents get a second annotation with choices
    ['yes', 'no'].
    """
    lab = read_table(spark, sf_dir, "labels")
    q = F.col("quality") == 1
    choices = (F.when(F.col("doc_id") % 13 == 0, F.array().cast("array<string>"))
               .when(F.col("doc_id") % 4 == 0, F.array(F.when(q, "dfy").otherwise("dfn")))
               .otherwise(F.array(F.when(q, "yes").otherwise("no"))))

    def ann(ch):
        return F.struct(F.array(F.struct(F.struct(ch.alias("choices")).alias("value"))).alias("result"))

    anns = F.when(F.col("toxic") == 1, F.array(ann(choices), ann(F.array(F.lit("yes"), F.lit("no"))))) \
        .otherwise(F.array(ann(choices)))
    anns = F.when(F.col("doc_id") % 19 == 0, F.lit(None)).when(F.col("doc_id") % 17 == 0, F.slice(anns, 1, 0)).otherwise(anns)
    data = F.struct(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
                    F.col("doc_id").cast("string").alias("id_hash"))
    return lab.select(data.alias("data"), anns.alias("annotations"))


EXPORT_SQL = """export AS (
  SELECT {'title': 'doc ' || CAST(doc_id AS VARCHAR), 'id_hash': CAST(doc_id AS VARCHAR)} AS data,
         CASE WHEN doc_id % 19 = 0 THEN NULL
              WHEN doc_id % 17 = 0 THEN list_slice([{'result': [{'value': {'choices': ch}}]}], 2, 1)
              WHEN toxic = 1 THEN [{'result': [{'value': {'choices': ch}}]},
                                   {'result': [{'value': {'choices': ['yes', 'no']}}]}]
              ELSE [{'result': [{'value': {'choices': ch}}]}] END AS annotations
  FROM (SELECT doc_id, toxic,
               CASE WHEN doc_id % 13 = 0 THEN []::VARCHAR[]
                    WHEN doc_id % 4 = 0 THEN [CASE WHEN quality = 1 THEN 'dfy' ELSE 'dfn' END]
                    ELSE [CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END] END AS ch
        FROM labels))"""


def title_col(text_col: str = "text"):
    """Title = first line of the text."""
    return F.substring_index(F.col(text_col), "\n", 1)


def title_sql(text_sql: str = "text") -> str:
    return f"split_part({text_sql}, chr(10), 1)"


def categories_col():
    """Derived list column: NULL when doc_id % 5 = 0, [] when 1, else [lang, source]."""
    m = F.col("doc_id") % 5
    return (F.when(m == 0, F.lit(None).cast("array<string>"))
            .when(m == 1, F.array().cast("array<string>"))
            .otherwise(F.array("lang", "source")))


CATEGORIES_SQL = """CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN []::VARCHAR[]
     ELSE [lang, source] END"""
