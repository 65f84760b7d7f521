"""Best-fit packing of documents into token sequences, improved by swap-based local search.

A document is its token ids and one closing id.  One longer than ``capacity`` is cut into pieces of ``capacity`` tokens,
the first of which takes what is over.  Pieces are dealt to packing groups by a hash; each group places its pieces by
best-fit decreasing and then improves the result: while it has more bins than the total length asks for, pieces of less
filled bins are moved to, or exchanged one-for-one, two-for-one or one-for-two with, pieces of fuller bins such that the
fuller bin grows.  Every step raises the sum of squared fills, so the search ends; bins that lose all pieces go.

Scale: documents never move; one scan turns each text into rows of a few numbers, and only these are shuffled, once.
A group holds about ``GROUP_ROWS`` documents' pieces, so a task's memory does not grow with the input; the number of
groups does.  Each group wastes less than about one sequence.

Defined cases: null texts count as empty and give one piece that holds the closing id alone; repeated rows are packed
each for itself and spread over the groups in blocks of 64; equal lengths are placed in order of id, piece and crc; a very long text gives as many pieces as it
needs; an empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.bpe_ids import worker_ids

CAPACITY = 1024
CLOSING_ID = 2
GROUP_ROWS = 8192
COPIES = 64  # of a repeated row that are dealt together


def cut_points(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``length`` tokens."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces_of(docs: DataFrame, vocabulary: str, closing_id: int = CLOSING_ID, capacity: int = CAPACITY,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    end = np.array([closing_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_ids(shared.value)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = encoder.ids(text or "") + end
                for piece, (start, length) in enumerate(cut_points(len(raw) // 4, capacity)):
                    for column, value in zip(out, (doc_id, piece, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]))):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers; ``lengths`` in the order of placing (longest first)."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for item, length in enumerate(lengths.tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
        left = room - length
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


class _Offers:
    """For each token count the fullest use of an exchange partner: what bins would give back, by how much room they have.

    ``best[n]`` is n plus the greatest room of a bin that can give back n tokens, so a bin that receives g tokens and
    gives back n fits if ``best[n] >= g``.  Entries of bins that have changed since are dropped when they come up.
    """

    def __init__(self, capacity: int):
        self.heaps: list[list[tuple]] = [[] for _ in range(capacity + 1)]
        self.best = np.full(capacity + 1, -1, dtype=np.int64)

    def add(self, tokens: int, room: int, bin_: int, version: int, items: list[int]) -> None:
        heapq.heappush(self.heaps[tokens], (-room, bin_, version, items))
        self.best[tokens] = max(self.best[tokens], tokens + room)

    def top(self, tokens: int, version: list[int]) -> tuple | None:
        """The valid entry with most room."""
        heap = self.heaps[tokens]
        while heap and version[heap[0][1]] != heap[0][2]:
            heapq.heappop(heap)
        self.best[tokens] = tokens - heap[0][0] if heap else -1
        return heap[0] if heap else None


class _Search:
    """Exchanges between underfull bins."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths.tolist(), capacity
        self.fill = [sum(self.lengths[i] for i in b) for b in bins]
        self.version = [0] * len(bins)
        self.one, self.two = _Offers(capacity), _Offers(capacity)  # giving back at most one item, giving back two
        for b in range(len(bins)):
            self.offer(b)

    def offer(self, b: int) -> None:
        room, version, items = self.capacity - self.fill[b], self.version[b], self.bins[b]
        if not room or not items:
            return
        self.one.add(0, room, b, version, [])
        for k, i in enumerate(items):
            self.one.add(self.lengths[i], room, b, version, [i])
            for j in items[:k]:
                self.two.add(self.lengths[i] + self.lengths[j], room, b, version, [i, j])

    def partner(self, offers: _Offers, given: int, source: int) -> tuple[int, tuple] | None:
        """The exchange that leaves most of ``given`` tokens in another bin and raises the sum of squared fills."""
        for back in np.flatnonzero(offers.best[:given] >= given).tolist():
            entry = offers.top(back, self.version)
            gain = given - back
            if entry and -entry[0] >= gain and self.fill[entry[1]] + gain > self.fill[source]:
                return gain, entry
        return None

    def improve(self, source: int) -> bool:
        """Make the best exchange out of ``source``, if there is one."""
        items = self.bins[source]
        found: tuple[int, tuple, list[int]] | None = None
        for k, i in enumerate(items):
            for give, offers in [([i], self.one), ([i], self.two)] + [([i, j], self.one) for j in items[:k]]:
                given = sum(self.lengths[x] for x in give)
                if (found is None or given > found[0]) and (p := self.partner(offers, given, source)) and (found is None or p[0] > found[0]):
                    found = (p[0], p[1], give)
        if not found:
            return False
        gain, (_, target, _, back), give = found
        self.bins[source] = [x for x in items if x not in give] + back
        self.bins[target] = [x for x in self.bins[target] if x not in back] + give
        self.fill[source] -= gain
        self.fill[target] += gain
        self.version[target] += 1
        self.offer(target)
        return True


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Fewer bins where exchanges between underfull ones allow it."""
    fills = [int(lengths[b].sum()) for b in bins]
    full = [b for b, f in zip(bins, fills) if f >= capacity]
    search = _Search([b for b, f in zip(bins, fills) if f < capacity], lengths, capacity)
    spare = capacity * len(search.bins) - sum(search.fill)
    moved = True
    while moved and spare >= capacity:
        moved = False
        for source in sorted(range(len(search.bins)), key=search.fill.__getitem__):
            if not search.bins[source] or search.fill[source] == capacity:
                continue
            search.version[source] += 1  # no partner of itself
            while search.bins[source] and search.improve(source):
                moved = True
            search.offer(source)
            if not search.bins[source]:
                spare -= capacity
                if spare < capacity:
                    break
    return full + [b for b in search.bins if b]


def pack_group(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """``frame`` with ``bin`` (from 0) and ``offset``."""
    frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                              kind="stable", ignore_index=True)
    lengths = frame["length"].to_numpy()
    bins = local_search(best_fit_decreasing(lengths, capacity), lengths, capacity)
    number, offset = np.zeros(len(frame), dtype=np.int64), np.zeros(len(frame), dtype=np.int64)
    for b, items in enumerate(bins):
        number[items] = b
        offset[items] = np.cumsum(lengths[items]) - lengths[items]
    return frame.assign(bin=number, offset=offset)


def pack(pieces: DataFrame, groups: int, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (see ``pieces_of``) with ``sequence_id`` and ``offset``."""
    # Equal rows are counted and dealt in blocks, or all copies of a repeated row would fall into one group.
    equal = pieces.groupBy("doc_id", "piece", "start", "length", "ids_crc32").agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - 1) / COPIES).cast("bigint")
    blocks = equal.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_block"))
    blocks = blocks.withColumn("_n", F.least(F.lit(COPIES), F.col("_n") - F.col("_block") * COPIES).cast("int"))
    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "_block", F.lit(5)), F.lit(groups))
    dealt = blocks.withColumn("_group", group).drop("_block")

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.loc[np.repeat(np.arange(len(frame)), frame["_n"].to_numpy())]
        packed = pack_group(frame.drop(columns=["_group", "_n"]), capacity)
        packed["sequence_id"] = (int(key[0]) << 32) + packed.pop("bin")
        return packed[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return dealt.groupBy("_group").applyInPandas(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocabulary_path: str, group_rows: int = GROUP_ROWS, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents; ``docs`` is counted once to choose the number of groups.

    The vocabulary file (about 2 MB) is read on the driver and broadcast, so executors need no copy of it.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    groups = max(1, math.ceil(docs.count() / group_rows))
    return pack(pieces_of(docs, vocabulary, capacity=capacity), groups, capacity)


def op5_packing_swaps(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
