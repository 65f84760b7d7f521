"""Shared helpers of the training-data operators: Arrow batches in, numpy arrays out.

Texts arrive as Arrow string columns.  The helpers work on their UTF-8 buffers directly, in pieces of about
``PIECE_BYTES``, so memory stays flat whatever the batch holds; a single text longer than that is a piece of its own.

Words are maximal runs of bytes that are not ASCII white space, with ASCII letters lower-cased.  A word's 64-bit hash
is a polynomial over its bytes, so all words of a piece are hashed with a few vector operations.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PIECE_BYTES = 1 << 20
SHINGLE_WORDS = 5

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over all output bits."""
    x = np.array(x, dtype=np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A pseudo-random 64-bit value for each byte, made from a rule.
_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BYTE_VALUE_LOWER = _BYTE_VALUE[_LOWER]
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64; kept for pieces of the usual size."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.ones(1, dtype=np.uint64)
        step = base
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(step)])
            step = step * step % (1 << 64)
        out.append(p)
    if n <= 4 * PIECE_BYTES:
        _POWERS[:] = out
    return out[0], out[1]


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """``p`` with ``span_hash(p, s, e)`` = hash of ``data[s:e]``, for any spans of the buffer."""
    pow_, _ = _powers(len(data) + 1)
    values = (_BYTE_VALUE_LOWER if lower else _BYTE_VALUE)[data]
    values *= pow_[:len(data)]
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def run_prefix(values: np.ndarray) -> np.ndarray:
    """The same for runs of 64-bit ``values``, e.g. hashes of words."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inv = _powers(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * inv[starts] + np.uint64(0x632BE59BD9B4E019))


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls count as empty texts."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(offs):
        offs = np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


class Words:
    """The words of some texts: ``start``, ``end`` (byte spans), ``row`` (text number), ``first`` (n + 1 offsets of
    each text's words) and ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        space = _SPACE[data]
        begins, stops = np.zeros(n, dtype=bool), np.zeros(n + 1, dtype=bool)
        if n:
            begins[1:] = space[:-1]
            begins[offsets[:-1][offsets[:-1] < n]] = True
            begins &= ~space
            stops[1:n] = space[1:]
            stops[offsets] = True
            stops[1:] &= ~space
            stops[0] = False
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops)
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.prefix = prefix_hash(data, lower=True)
        self.hash = span_hash(self.prefix, self.start, self.end) if len(self.start) else np.zeros(0, dtype=np.uint64)


def shingle_hashes(word_hash: np.ndarray, first: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and each text's offsets (n + 1) into them.

    A text with fewer words has one shingle of all its words, a text without words has none.
    """
    counts = np.diff(first)
    n_shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offs = np.concatenate([[0], np.cumsum(n_shingles)])
    if not offs[-1]:
        return np.zeros(0, dtype=np.uint64), offs
    at = np.repeat(first[:-1] - offs[:-1], n_shingles) + np.arange(offs[-1])
    out = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([word_hash, np.zeros(size, dtype=np.uint64)])
    length = np.repeat(np.minimum(counts, size), n_shingles)
    for j in range(size):
        term = padded[at + j]
        term[length <= j] = 0
        out *= np.uint64(_BASE)
        out += term
    return mix64(out + length.astype(np.uint64)), offs


def _malloc_trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None  # another C library: what it frees is left to it


_TRIM = _malloc_trim()


def release_memory() -> None:
    """Give freed memory of this process back to the system: a worker lives on between stages, and what one stage held would
    else count against the next."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], added: str,
                keep: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """``df``'s columns in ``keep`` (default: all) and the columns that ``fn`` computes for each Arrow batch.

    A column of ``df`` with the name of an added one is replaced by it.  One pass, no shuffle.  With ``rows``, ``fn`` gets
    at most so many rows at a time, which bounds what it holds.
    """
    new = T._parse_datatype_string(added)
    names = {f.name for f in new.fields}
    kept = [f for f in df.schema.fields if f.name not in names and (keep is None or f.name in keep)]
    schema = T.StructType(kept + list(new.fields))
    out_names, kept_names = [f.name for f in schema.fields], [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows or max(whole.num_rows, 1)):
                batch = whole.slice(at, rows) if rows else whole
                made = fn(batch)
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept_names] + list(made), names=out_names)
            made = batch = whole = None
            release_memory()

    return df.mapInArrow(run, schema)


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
