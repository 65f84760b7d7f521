"""Corpus preparation: the training-data operators applied one after the other to a documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet into the shared
checkpoint folder and reads it again as the next stage's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import near_dups, packing_swaps, pii_anchors, quality_nbsvm, repeats_bwt
from textlab.llm.fitdata import id_fold
from textlab.llm.tables import written

REPEATED_WORDS = 51


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text; a null text has null."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  It is fitted on labels of ids with crc32 mod 3 other than 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality_nbsvm.fit(source, labels, exclude=id_fold(F.col("doc_id"), 3) == 1)
    return quality_nbsvm.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    return near_dups.keep_one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes and runs of more than 50 words that occur more than once are cut out of the texts."""
    return _with_length(repeats_bwt.remove_repeats(docs, words=REPEATED_WORDS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in angle brackets."""
    return _with_length(pii_anchors.mask(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' tokens packed into sequences of at most 1024."""
    import public_tokenizers

    return packing_swaps.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL cannot express the classifier, the signatures or the packing; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
