"""Intermediate tables in the shared checkpoint folder.

Writing and rereading a table cuts its lineage and survives lost executors: the files lie in the folder that
``spark.checkpoint.dir`` names, which all executors share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from textlab.session import checkpoint_dir


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet into a new folder and read again, and the folder."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(df: DataFrame, *paths: str) -> None:
    """Delete folders that ``written`` made and nothing reads any more."""
    spark = df.sparkSession
    for p in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
