"""Readers for the parquet tables of a dataset folder.

``read_table`` returns a lazy scan; Catalyst prunes columns and pushes
filters into it, so callers select only what they need.

A scan has one task per file split.  When a table has fewer splits than the
cluster has task slots (small files, one row group) the rows are spread
round-robin so that the CPU-heavy text work after the scan runs on every slot.
On large inputs the scan already has more splits than slots and nothing is
added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Tables whose rows carry long texts: worth spreading when under-split.
TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread is None:
        spread = name in TEXT_TABLES
    if spread:
        slots = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < slots:
            df = df.repartition(slots)
    return df
