"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits.

Every five-word shingle is hashed once; the hash picks one of ``BINS`` bins and the value it offers there, and a bin
keeps its least value.  An empty bin copies a non-empty one: it tries the bins of a fixed pseudo-random sequence of its
own until one is not empty (optimal densification: the sequence depends on the bin and the try only, so two texts that
try the same bins agree as often as their sets do).  Of each bin's value the ``BITS`` low-order bits are kept and packed.

Two unrelated values agree in their low bits with chance 2^-BITS, so the share m of equal bins estimates Jaccard
similarity as (m - 2^-BITS) / (1 - 2^-BITS), cut to 0..1.

Scale: fingerprints are one scan.  Comparing each document with the next in descending id needs neighbours in one place:
texts are shuffled once, into ranges of ids, each sorted by Spark and read as a stream that holds one batch; the first
row of each range is sent to the range before it as well.  Range bounds are approximate quantiles of the ids.

Defined cases: null and empty texts and those of blanks only have no shingle and the fingerprint ""; it is like itself
(1.0) and unlike all others (0.0); a null id is ordered after all others; rows of one id are ordered by text, so repeated
rows are each other's neighbours; a single row is its own next document; an empty table gives an empty result; other
columns do not enter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.textkit import Words, mix64, pieces, shingle_hashes, utf8_buffer

BINS = 256
BITS = 4
_LEAST = -(1 << 63)
_DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def densified(least: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """``least`` (texts x bins) with empty bins filled from the first non-empty bin of their own sequence.

    Every text has a non-empty bin.
    """
    bins = least.shape[1]
    out = least.copy()
    text, bin_ = np.nonzero(empty)
    turn = 0
    while len(text):
        turn += 1
        try_ = (mix64(bin_.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(bins)).astype(np.int64)
        filled = ~empty[text, try_]
        out[text[filled], bin_[filled]] = least[text[filled], try_[filled]]
        text, bin_ = text[~filled], bin_[~filled]
    return out


def bin_values(shingles: np.ndarray, offsets: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(values (texts with shingles x bins), which texts those are)."""
    counts = np.diff(offsets)
    has = np.flatnonzero(counts > 0)
    row = np.repeat(np.arange(len(has)), counts[has])
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(len(has) * bins, none)
    at = row * bins + (shingles % np.uint64(bins)).astype(np.int64)
    np.minimum.at(least, at, shingles >> np.uint64(9))
    least = least.reshape(len(has), bins)
    return densified(least, least == none), has


def fingerprints(data: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Values of ``BITS`` bits (texts x bins); 255 marks a text without shingles."""
    out = np.full((len(offsets) - 1, bins), 255, dtype=np.uint8)
    for a, b in pieces(offsets):
        words = Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        values, has = bin_values(*shingle_hashes(words.hash, words.first), bins)
        out[a + has] = (values & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return out


def packed(values: np.ndarray) -> list[str]:
    """One hexadecimal digit a bin; "" for texts without shingles."""
    lines = _DIGITS[np.minimum(values, 15)]
    return ["" if v[0] == 255 else line.tobytes().decode() for v, line in zip(values, lines)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of paired rows, corrected for chance agreement of low-order bits."""
    chance = 2.0 ** -BITS
    out = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    no_a, no_b = a[:, 0] == 255, b[:, 0] == 255
    return np.where(no_a & no_b, 1.0, np.where(no_a | no_b, 0.0, out))


def edited_text(text: str, after: str) -> str:
    """``text`` with its last third (code points, rounded down) replaced by as many of the first of ``after``."""
    n = len(text) // 3
    return text[:len(text) - n] + after[:n]


_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _column(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return utf8_buffer(pa.array(texts, type=pa.large_string()))


def _results(ids: list, texts: list[str], values: np.ndarray) -> pa.RecordBatch:
    """Result rows of all but the last of consecutive rows."""
    edited = [edited_text(t, after) for t, after in zip(texts, texts[1:])]
    edited_values = fingerprints(*_column(edited))
    columns = [pa.array(ids[:-1], type=pa.int64()), pa.array([len(t) for t in texts[:-1]], type=pa.int64()),
               pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]), pa.array(packed(values[:-1])),
               pa.array(packed(edited_values)), pa.array(likeness(values[:-1], edited_values)), pa.array(likeness(values[:-1], values[1:]))]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likeness of its fingerprint to the edited text's and to
    that of the next document in descending id (after the last: the first)."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    source = source.withColumn("_order", F.coalesce("doc_id", F.lit(_LEAST)))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.unique(np.array([int(x) for x in source.select(F.col("_order").cast("double")).approxQuantile(
        "_order", [i / ranges for i in range(1, ranges)], 0.25 / ranges)] if ranges > 1 else [], dtype=np.float64))
    cuts = cuts[(cuts > -9.2e18) & (cuts < 9.2e18)].astype(np.int64)

    @F.pandas_udf("int")
    def range_of(order: pd.Series) -> pd.Series:
        return pd.Series((len(cuts) - np.searchsorted(cuts, order.to_numpy(), side="right")).astype(np.int32))

    # The first row of each range in use is the next one of the last row of the range before (cyclic).
    heads = sorted((r["range"], r["head"]) for r in source.groupBy(range_of("_order").alias("range")).agg(F.max("_order").alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def homes(order: pd.Series) -> pd.Series:
        own = len(cuts) - np.searchsorted(cuts, order.to_numpy(), side="right")
        return pd.Series([[r, before[o]] if o in before else [r] for r, o in zip(own.tolist(), order.tolist())])

    placed = (source.select("doc_id", "text", "_order", F.posexplode(homes("_order")).alias("_guest", "_range"))
              .repartitionById(max(1, len(cuts) + 1), F.col("_range"))
              .sortWithinPartitions("_range", "_guest", F.col("_order").desc(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        values = np.zeros((0, BINS), dtype=np.uint8)
        closed = False
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                guests = part.column("_guest").to_numpy()
                take = int(np.searchsorted(guests, 1, side="right")) if not closed else 0
                take = min(take, int(np.searchsorted(guests, 1)) + 1)  # of the guests, the first
                if not take:
                    continue
                closed = bool(guests[take - 1])
                new = part.column("text").slice(0, take).to_pylist()
                ids, texts = ids + part.column("doc_id").slice(0, take).to_pylist(), texts + new
                values = np.concatenate([values, fingerprints(*_column(new))])
                if len(texts) > 1:
                    yield _results(ids, texts, values)
                    ids, texts, values = ids[-1:], texts[-1:], values[-1:]

    return placed.mapInArrow(run, _RESULT)


def op2_fingerprints_oph(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
