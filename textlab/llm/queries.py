"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textlab.llm.ann_forest import op4_ann_forest
from textlab.llm.fingerprints_oph import op2_fingerprints_oph
from textlab.llm.merge_dropout import op8_merge_dropout
from textlab.llm.merkle_intervals import SQL as MERKLE_SQL
from textlab.llm.merkle_intervals import op11_merkle_intervals
from textlab.llm.mix_schedule import SQL as MIX_SQL
from textlab.llm.mix_schedule import op12_mix_schedule
from textlab.llm.near_dups import op7_near_dups
from textlab.llm.packing_swaps import op5_packing_swaps
from textlab.llm.phrases_streams import SQL as PHRASES_SQL
from textlab.llm.phrases_streams import op13_phrases_streams
from textlab.llm.pii_anchors import op9_pii_anchors
from textlab.llm.quality_nbsvm import op10_quality_nbsvm
from textlab.llm.repeats_bwt import op3_repeats_bwt
from textlab.llm.shards_histogram import op6_shards_histogram
from textlab.llm.toxicity_gru import op1_toxicity_gru

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_gru": op1_toxicity_gru,
    "op2_fingerprints_oph": op2_fingerprints_oph,
    "op3_repeats_bwt": op3_repeats_bwt,
    "op4_ann_forest": op4_ann_forest,
    "op6_shards_histogram": op6_shards_histogram,
    "op7_near_dups": op7_near_dups,
    "op8_merge_dropout": op8_merge_dropout,
    "op5_packing_swaps": op5_packing_swaps,
    "op9_pii_anchors": op9_pii_anchors,
    "op10_quality_nbsvm": op10_quality_nbsvm,
    "op11_merkle_intervals": op11_merkle_intervals,
    "op12_mix_schedule": op12_mix_schedule,
    "op13_phrases_streams": op13_phrases_streams,
}

SQL: dict[str, str] = {
    "op11_merkle_intervals": MERKLE_SQL,
    "op12_mix_schedule": MIX_SQL,
    "op13_phrases_streams": PHRASES_SQL,
}
