"""Readers and writers.

Every reader takes an explicit schema (no inference on large inputs).  Large
archives and JSON arrays are split over tasks by ``sources/split.py``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.sources.split import read_archive_members, read_json_records  # noqa: F401

# Schema of a labelling-tool export (the fields the pipeline uses).
EXPORT_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("title", T.StringType()), T.StructField("id_hash", T.StringType())])),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("result", T.ArrayType(T.StructType([
            T.StructField("value", T.StructType([
                T.StructField("choices", T.ArrayType(T.StringType()))]))])))]))),
])

LABEL_SCHEMA = T.StructType([T.StructField("id_hash", T.StringType()), T.StructField("label", T.LongType())])

# The results log schema (+ status, run timestamp).
RESULTS_SCHEMA = T.StructType([
    T.StructField("f1", T.DoubleType()), T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("label_col", T.StringType()), T.StructField("text_col", T.StringType()),
    T.StructField("experiment", T.StringType()), T.StructField("run_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
])


def read_annotation_export(spark: SparkSession, path: str, schema: T.StructType = EXPORT_SCHEMA) -> DataFrame:
    """A JSON array (or JSON lines) export with an explicit nested schema; a file is one task.

    ``read_json_records`` splits one large file over tasks and keeps broken records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_label_csv(spark: SparkSession, path: str, schema: T.StructType = LABEL_SCHEMA) -> DataFrame:
    """Label files with a header and an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header (arrays joined first: CSV has no array type)."""
    cols = [F.array_join(F.col(f.name), ",").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """S6."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_delivery(all_rows: DataFrame, positives: DataFrame, path: str) -> None:
    """Two datasets, every cell as string (spreadsheet-friendly)."""
    for name, df in (("all_data", all_rows), ("positive_examples", positives)):
        df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite") \
            .option("header", True).csv(f"{path.rstrip('/')}/{name}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the file system that Spark resolves it to."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The results log, or an empty frame with its schema when the path is
    absent.  Any other failure (rights, a corrupt file, the network) is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], RESULTS_SCHEMA)
    return spark.read.schema(RESULTS_SCHEMA).parquet(path)


def append_results(df: DataFrame, path: str) -> None:
    """Append rows, aligned and cast to the fixed schema."""
    cols = []
    for f in RESULTS_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "run_at":
            cols.append(F.current_timestamp().alias("run_at"))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    df.select(*cols).write.mode("append").parquet(path)


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """A flat parameter map as one JSON row."""
    spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "params string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_rules(rules: DataFrame, path: str) -> None:
    """Rules as a Parquet table (rank, pattern, pos, neg, score)."""
    rules.write.mode("overwrite").parquet(path)


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    """A fitted PipelineModel."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
