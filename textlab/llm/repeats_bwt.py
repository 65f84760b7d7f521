"""Removal of repeated byte strings by column-wise construction of suffix order and common prefixes.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else in the collection is removed, first
occurrences included; strings are judged on the input.

Documents that can share such a string are brought together first.  Among the runs of ``GRAM`` bytes inside a string,
the one with the least hash (the leftmost of equal ones) depends on the string alone, so two equal strings have it at
the same offset: their documents meet at that anchor, aligned.  Anchors that occur at one place only leave after one
shuffle of hashes.

All documents that meet at an anchor form a collection whose Burrows-Wheeler transform is built column by column from
the right: each round puts one symbol in front of every document's suffix, which turns the order of the suffixes of the
last round into that of this round by one stable sort on the new symbols (they are the transform's next column), and
the common prefix of neighbours becomes one more than the least common prefix between their old places, or nothing where
their symbols differ.  Equal strings start in the same column of a collection, so only suffixes of one column are ever
compared, and the arrays of a round replace those of the last.  After a round, a suffix with ``LENGTH`` bytes in common
with a neighbour starts a repeated string.  The collections lie one after the other in Spark's sorted shuffle files,
which are read in sequence, in blocks of whole collections; many are worked on at once.

Members with the same bytes around the anchor (copied passages, texts of one repeated word) enter a collection as one
context; if a context has several members, all their strings repeat.  A collection of more than ``HOT_ROWS`` different
contexts would not fit a task.  Its contexts are counted instead by the hash of each of their strings that the anchor
marks, an aggregation with partial sums, which gives the same starts.

With ``words``, runs of so many words that occur more than once (words equal byte by byte, white space between them not
compared) are removed too, however short they are in bytes.  They meet in the same way, by the run of ``WORD_GRAM`` words with
the least hash; the runs at shared anchors are counted by their hashes, one context per distinct neighbourhood.

Scale: whole texts are shuffled once, and only those with a shared anchor are kept.  Copies of a whole text collapse
before that; they are removed entirely.  Everything else that moves is anchors and the bytes around shared ones.

Defined cases: null and empty texts and those of less than ``LENGTH`` bytes lose nothing unless they repeat inside
longer ones, which cannot be; repeated rows are copies of each other; ties between equal hashes go to the leftmost;
an empty table gives an empty result; other columns do not enter (``remove_repeats`` hands them on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.bloom import Bloom, bloom_of
from textlab.llm.tables import discard, written
from textlab.llm.textkit import Words, map_batches, pieces, prefix_hash, run_prefix, span_hash, utf8_buffer

LENGTH = 400
GRAM = 200
WORD_GRAM = 26
HOT_ROWS = 40_000
BLOCK_ROWS = 16_384
SALTS = 8
WORDS = 51
_LOW = np.uint64(0xFFFFFFFF)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in the buffer, ascending) of all strings' anchors, and their 64-bit hashes."""
    if len(data) < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.arange(len(data) - gram + 1)
    hashes = span_hash(prefix_hash(data), at, at + gram)
    where = np.unique(anchor_of_each(hashes, offsets, length, gram)[1])
    return where, hashes[where]


def anchor_of_each(hashes: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all strings that lie inside a text, and their anchors.  ``hashes``: of the gram at every place."""
    n, span = len(hashes) + gram - 1, length - gram + 1
    at = np.arange(len(hashes))
    order = (hashes & ~_LOW) | at.astype(np.uint64)  # equal hashes: leftmost
    blocks = -(-len(order) // span)
    padded = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(order)] = order
    table = padded.reshape(blocks, span)
    to_here = np.minimum.accumulate(table, axis=1).ravel()
    from_here = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1  # a window of gram hashes per string
    least = np.minimum(from_here[:starts], to_here[span - 1:span - 1 + starts])
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    inside = np.arange(starts) + length <= row_end[:starts]
    return np.flatnonzero(inside), (least[inside] & _LOW).astype(np.int64)


def word_anchors(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words, the prefix of their hashes, the first word of every run of ``words`` words, and its anchor (a word
    number); the last are the hashes of the grams."""
    w = Words(data, offsets)
    none = np.zeros(0, dtype=np.int64)
    if len(w.start) < words:
        return w, none, none, none, none.astype(np.uint64)
    prefix = run_prefix(span_hash(prefix_hash(data), w.start, w.end))
    gram = min(WORD_GRAM, words)
    at = np.arange(len(w.start) - gram + 1)
    hashes = mark_words(span_hash(prefix, at, at + gram))
    return w, prefix, *anchor_of_each(hashes, w.first, words, gram), hashes


def mark_words(hashes: np.ndarray) -> np.ndarray:
    """Hashes of grams of words, told from those of bytes."""
    return hashes ^ np.uint64(0x5851F42D4C957F2D)


def _key(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def survey(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, words: int | None = None) -> DataFrame:
    """One row per document: doc_id, key (digest of the text), n_bytes, n_words (0 without ``words``), sha256, and its anchors
    as arrays; the place of an anchor of words is -1 - the word's number."""
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = utf8_buffer(batch.column("_text"))
        raw = data.tobytes()
        bounds = offsets.tolist()
        keys = [_key(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
        shas = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]
        places, hashes, counts, n_words = [], [], [], []
        for a, b in pieces(offsets):
            local = offsets[a:b + 1] - offsets[a]
            where, found = anchors(data[offsets[a]:offsets[b]], local, length, gram)
            row = np.searchsorted(local, where, side="right") - 1
            place = where - local[row]
            if words:
                w, _, _, anchor, of_gram = word_anchors(data[offsets[a]:offsets[b]], local, words)
                anchor = np.unique(anchor)
                row = np.concatenate([row, w.row[anchor]])
                place = np.concatenate([place, -1 - (anchor - w.first[w.row[anchor]])])
                found = np.concatenate([found, of_gram[anchor]])
                order = np.argsort(row, kind="stable")
                row, place, found = row[order], place[order], found[order]
                n_words.append(np.diff(w.first))
            else:
                n_words.append(np.zeros(b - a, dtype=np.int64))
            places.append(place)
            hashes.append(found)
            counts.append(np.bincount(row, minlength=b - a))
        offs = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32))
        return [pa.array(keys, type=pa.binary()), pa.array(np.diff(offsets)), pa.array(np.concatenate(n_words)), pa.array(shas),
                pa.ListArray.from_arrays(offs, pa.array(np.concatenate(hashes).view(np.int64))),
                pa.ListArray.from_arrays(offs, pa.array(np.concatenate(places).astype(np.int32)))]

    return map_batches(source, run, "key binary, n_bytes bigint, n_words bigint, sha256 string, hashes array<bigint>, places array<int>",
                       keep=["doc_id"])


def _texts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(key, text) of texts long enough to hold a string; copies within a task are dropped at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            data, offsets = utf8_buffer(batch.column("_text"))
            raw, bounds = data.tobytes(), offsets.tolist()
            keys, texts = [], []
            for a, b in zip(bounds, bounds[1:]):
                if b - a >= length and (key := _key(raw[a:b])) not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()  # copies that slip through are dropped after the shuffle
                    seen.add(key)
                    keys.append(key)
                    texts.append(raw[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.binary()), pa.array(texts, type=pa.binary())], names=["key", "text"])

    return docs.select(F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, "key binary, text binary")


_MEMBER = "hash bigint, context bigint, key binary, place int, n_left int, n_right int, left binary, right binary"


def members_of(affected: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per text and shared anchor: the bytes ``left`` of it and ``right`` of its gram, a hash of both as
    ``context``, and their numbers.  A task gives the bytes of a context once, null after that."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            columns: tuple[list, ...] = tuple([] for _ in range(8))
            for key, text, found in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                for f in found:
                    p, anchor = f["place"], f["hash"]
                    if p < 0:
                        continue  # an anchor of words
                    left, right = text[max(0, p - reach):p], text[p + gram:p + gram + reach]
                    digest = hashlib.blake2b(left + right, digest_size=8, salt=len(left).to_bytes(8, "little")).digest()
                    context = int.from_bytes(digest, "little", signed=True)
                    new = (anchor, context) not in seen
                    if new:
                        if len(seen) >= 200_000:
                            seen.clear()  # bytes given twice are dropped after the shuffle
                        seen.add((anchor, context))
                    row = (anchor, context, key, p, len(left), len(right), left if new else None, right if new else None)
                    for column, value in zip(columns, row):
                        column.append(value)
                    if len(columns[0]) >= 10_000:
                        yield _member_batch(columns)
                        columns = tuple([] for _ in range(8))
            yield _member_batch(columns)

    return affected.mapInArrow(run, _MEMBER)


def _member_batch(columns: tuple[list, ...]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _MEMBER.split(", ")])


_OUTSIDE = 256  # symbol before a text's begin or after its end; equal to nothing


def symbol_table(values: list[bytes], width: int, from_right: bool) -> np.ndarray:
    """values as rows of ``width`` symbols, flush right or left, the rest filled with ``_OUTSIDE``."""
    lengths = np.array([len(v) for v in values])
    flat = np.frombuffer(b"".join(values), dtype=np.uint8)
    column = np.arange(width)[None, :]
    inside = column >= (width - lengths)[:, None] if from_right else column < lengths[:, None]
    table = np.full((len(values), width), _OUTSIDE, dtype=np.int16)
    table[inside] = flat
    return table


class ColumnOrder:
    """Suffix order and common prefixes of aligned documents in collections, grown by one column a round."""

    def __init__(self, collection: np.ndarray):
        """``collection``: ascending collection numbers of the documents."""
        self.order = np.arange(len(collection))
        self.collection = collection.astype(np.int64)
        self.common = np.zeros(len(collection) + 1, dtype=np.int64)  # with the document before in the order

    def insert(self, symbols: np.ndarray) -> None:
        """Put ``symbols`` (one per document) in front of all suffixes."""
        here = symbols[self.order].astype(np.int64)  # the transform's column
        if (here[1:] == here[:-1]).all() and len(here) and here[0] != _OUTSIDE:
            self.common[:-1] += 1
            self.common[:-1][self._first()] = 0
            return
        group = self.collection[self.order]
        place = np.argsort(group * 512 + here, kind="stable")
        group, here = group[place], here[place]
        same = np.zeros(len(place), dtype=bool)
        same[1:] = (group[1:] == group[:-1]) & (here[1:] == here[:-1]) & (here[1:] != _OUTSIDE)
        common = np.zeros(len(place) + 1, dtype=np.int64)
        at = np.flatnonzero(same)
        if len(at):
            spans = np.empty(2 * len(at), dtype=np.int64)
            spans[0::2], spans[1::2] = place[at - 1] + 1, place[at] + 1
            common[at] = np.minimum.reduceat(self.common, spans)[::2] + 1
        self.order, self.common = self.order[place], common

    def _first(self) -> np.ndarray:
        group = self.collection[self.order]
        first = np.ones(len(group), dtype=bool)
        first[1:] = group[1:] != group[:-1]
        return first

    def extend(self, columns: int) -> None:
        """Put ``columns`` symbols that are equal within each collection in front of all suffixes."""
        self.common[:-1] += columns
        self.common[:-1][self._first()] = 0

    def repeated(self, length: int) -> np.ndarray:
        """Documents whose suffix has ``length`` symbols in common with a neighbour's."""
        near = np.maximum(self.common[:-1], np.append(self.common[1:-1], 0))
        return self.order[near >= length]


def repeated_starts(group: np.ndarray, left: list[bytes], right: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest start, relative to the anchor, of each member's repeated strings; 1 and -1 - reach if none."""
    reach = length - gram
    order = ColumnOrder(group)
    after, before = symbol_table(right, reach, False), symbol_table(left, reach, True)
    for c in range(reach - 1, -1, -1):
        order.insert(after[:, c])
    order.extend(gram)
    low, high = np.full(len(group), 1), np.full(len(group), -1 - reach)
    for start in range(0, -reach - 1, -1):
        if start:
            order.insert(before[:, reach + start])
        found = order.repeated(length)
        low[found] = start
        fresh = found[high[found] < -reach]
        high[fresh] = start
    return low, high


_STARTS = "hash bigint, context bigint, low int, high int"


def _starts_of(rows: pa.Table, length: int, gram: int) -> pa.RecordBatch:
    hashes, contexts = rows.column("hash").to_numpy(), rows.column("context").to_numpy()
    once = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (contexts[1:] != contexts[:-1])))
    rows, hashes = rows.take(pa.array(once)), hashes[once]
    group = np.concatenate([[0], np.cumsum(hashes[1:] != hashes[:-1])])
    low, high = repeated_starts(group, rows.column("left").to_pylist(), rows.column("right").to_pylist(), length, gram)
    found = np.flatnonzero(low <= 0)
    take = pa.array(found)
    return pa.RecordBatch.from_arrays([rows.column("hash").take(take).combine_chunks(), rows.column("context").take(take).combine_chunks(),
                                       pa.array(low[found].astype(np.int32)), pa.array(high[found].astype(np.int32))],
                                      names=[f.split()[0] for f in _STARTS.split(", ")])


def collection_starts(contexts: DataFrame, length: int, gram: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(hash, context, low, high): least and greatest start, relative to the anchor, of a context's strings that another
    context of its collection holds too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < block_rows:
                continue
            table = pa.Table.from_batches(held)
            hashes = table.column("hash").to_numpy()
            last = int(np.searchsorted(hashes, hashes[-1]))  # the last collection may go on
            if last:
                yield _starts_of(table.slice(0, last), length, gram)
            held = table.slice(last).to_batches()
            rows -= last
        if rows:
            yield _starts_of(pa.Table.from_batches(held), length, gram)

    return (contexts.select("hash", "context", "left", "right").repartition("hash").sortWithinPartitions("hash", "context")
            .mapInArrow(run, _STARTS))


def counted_starts(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for the contexts of very large collections, by counting their strings."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lefts, rights = part.column("left").to_pylist(), part.column("right").to_pylist()
                data = np.frombuffer(b"".join(x + y for x, y in zip(lefts, rights)), dtype=np.uint8)
                size = np.array([[len(x), len(x) + len(y)] for x, y in zip(lefts, rights)])
                base = np.concatenate([[0], np.cumsum(size[:, 1])])[:-1]
                # The gram is equal for all members, so a string's other bytes stand for it.
                owner = np.repeat(np.arange(part.num_rows), reach + 1)
                start = np.tile(np.arange(-reach, 1), part.num_rows)
                begin, end = size[owner, 0] + start, size[owner, 0] + start + reach
                inside = (begin >= 0) & (end <= size[owner, 1])
                owner, start, begin, end = owner[inside], start[inside], begin[inside], end[inside]
                value = span_hash(prefix_hash(data), base[owner] + begin, base[owner] + end)
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays([part.column("hash").take(take), part.column("context").take(take),
                                                  pa.array(start.astype(np.int32)), pa.array(value.view(np.int64))],
                                                 names=["hash", "context", "start", "value"])

    strings = contexts.select("hash", "context", "left", "right").mapInArrow(run, "hash bigint, context bigint, start int, value bigint")
    same = ["hash", "start", "value"]
    twice = strings.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*same)
    return strings.join(twice, same).groupBy("hash", "context").agg(F.min("start").alias("low"), F.max("start").alias("high"))


def repeated_spans(members: DataFrame, length: int, gram: int, hot_rows: int) -> DataFrame:
    """(key, start, end): what repeats around each anchor of each text.  ``members``: a table as of ``members_of``."""
    reach = length - gram
    contexts = members.where("left is not null")
    large = contexts.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select("hash")
    if large.isEmpty():
        starts = collection_starts(contexts, length, gram)
    else:
        hot = contexts.join(large, "hash", "left_semi").dropDuplicates(["hash", "context"])
        starts = collection_starts(contexts.join(large, "hash", "left_anti"), length, gram).union(counted_starts(hot, length, gram))
    rows = members.select("hash", "context", "key", "place", "n_left", "n_right")
    several = rows.groupBy("hash", "context").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        "hash", "context", F.lit(-reach).alias("low"), F.lit(0).alias("high"))
    either = several.union(starts).groupBy("hash", "context").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    low = F.greatest(F.col("low"), -F.col("n_left"))
    high = F.least(F.col("high"), F.col("n_right") - reach)
    return (rows.join(either, ["hash", "context"]).where(low <= high)
            .select("key", (F.col("place") + low).cast("bigint").alias("start"), (F.col("place") + high + length).cast("bigint").alias("end")))


_RUNS = "hash bigint, context bigint, key binary, first int, n int, values array<bigint>"


def word_members(affected: DataFrame, words: int) -> DataFrame:
    """One row per text and shared anchor of words: the number ``first`` of the first of its ``n`` runs that have this anchor,
    their hashes as ``values``, and a hash of these as ``context``.  A task gives the values of a context once, null after that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            data, offsets = utf8_buffer(batch.column("text"))
            keys, found = batch.column("key").to_pylist(), batch.column("found").to_pylist()
            for a, b in pieces(offsets):
                w, prefix, start, anchor, of_gram = word_anchors(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                shared = [first - 1 - f["place"] for first, fs in zip(w.first.tolist(), found[a:b]) for f in fs if f["place"] < 0]
                here = np.isin(anchor, np.array(shared, dtype=np.int64))
                start, anchor = start[here], anchor[here]
                if not len(start):
                    continue
                value = span_hash(prefix, start, start + words).view(np.int64)
                cuts = np.flatnonzero(np.append(True, np.append(anchor[1:] != anchor[:-1], True)))
                raw, rows = value.tobytes(), []
                row = w.row[start[cuts[:-1]]]
                grams = of_gram[anchor[cuts[:-1]]].view(np.int64)
                for i, j, r, first, gram in zip(cuts.tolist(), cuts[1:].tolist(), row.tolist(), (start[cuts[:-1]] - w.first[row]).tolist(), grams.tolist()):
                    context = int.from_bytes(hashlib.blake2b(raw[i * 8:j * 8], digest_size=8).digest(), "little", signed=True)
                    new = (gram, context) not in seen
                    if new:
                        if len(seen) >= 200_000:
                            seen.clear()  # values given twice count once, by their context
                        seen.add((gram, context))
                    rows.append((gram, context, keys[a + r], first, j - i, value[i:j] if new else None))
                types = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)],
                                                 names=[f.split()[0] for f in _RUNS.split(", ")])

    return affected.where(F.exists("found", lambda f: f["place"] < 0)).mapInArrow(run, _RUNS)


def repeated_words(members: DataFrame, words: int) -> DataFrame:
    """(key, start, end): runs of at least ``words`` words that repeat, in numbers of words.  ``members``: a table as of
    ``word_members``."""
    runs = members.where("values is not null").select("hash", "context", F.posexplode("values").alias("at", "value"))
    # Equal runs share their anchor, so its hash and the run's are 128 bits together.
    twice = runs.groupBy("hash", "value").agg(F.min("context").alias("_a"), F.max("context").alias("_b")).where("_a <> _b").select("hash", "value")
    among = runs.join(twice, ["hash", "value"]).groupBy("hash", "context").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    rows = members.select("hash", "context", "key", "first", "n")
    several = rows.groupBy("hash", "context").agg(F.count(F.lit(1)).alias("_n"), F.max("n").alias("n")).where("_n > 1").select(
        "hash", "context", F.lit(0).alias("low"), (F.col("n") - 1).alias("high"))
    either = several.union(among).groupBy("hash", "context").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return rows.join(either, ["hash", "context"]).select(
        "key", (F.col("first") + F.col("low")).cast("bigint").alias("start"), (F.col("first") + F.col("high") + words).cast("bigint").alias("end"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by ``spans``."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return b"".join(kept) + text[at:]


def _run_lists(runs: list[list[tuple[int, int]]]) -> pa.Array:
    item = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], type=pa.list_(item))


def _marks_in(surveyed: DataFrame, wanted: Bloom) -> DataFrame:
    """(hash, key, place) of the marks whose hash the filter has."""
    shared = surveyed.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hashes")
            at = np.flatnonzero(shared.value.has(hashes.flatten().to_numpy()))
            row = np.repeat(np.arange(batch.num_rows), np.diff(hashes.offsets.to_numpy()))
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([hashes.flatten().take(take), batch.column("key").take(pa.array(row[at])),
                                              batch.column("places").flatten().take(take)], names=["hash", "key", "place"])

    kind = surveyed.schema["places"].dataType.elementType.simpleString()
    return surveyed.select("key", "hashes", "places").mapInArrow(run, f"hash bigint, key binary, place {kind}")


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                 hot_rows: int = HOT_ROWS, words: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """(documents, cuts, folders to discard after use).

    documents: doc_id, key, n_bytes, n_words, sha256, copies (how many rows have this text).  cuts: key, runs (array of struct
    start, end), kept (the remaining bytes) for texts that occur once and lose something.  With ``words`` also the same by
    strings of ``length`` bytes alone (byte_runs, byte_sha256) and by runs of words alone, in numbers of words (word_runs).
    """
    surveyed, surveyed_path = written(survey(docs, id_col, text_col, length, gram, words), "anchors")
    marks = surveyed.select(F.xxhash64("key").alias("k"), F.explode(F.arrays_zip("hashes", "places")).alias("m")).select(
        F.col("m.hashes").alias("hash"), F.struct("k", F.col("m.places").alias("place")).alias("where"))
    shared, shared_path = written(marks.groupBy("hash").agg(F.min("where").alias("_a"), F.max("where").alias("_b")).where("_a <> _b").select("hash"), "shared")
    # Only marks that a filter of the shared hashes lets through are shuffled; a very common anchor's marks go to SALTS tasks.
    salt = F.pmod(F.xxhash64("key", "place"), F.lit(SALTS)).alias("_salt")
    salted = shared.select("hash", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("_salt"))
    places = (_marks_in(surveyed, bloom_of(shared, "hash")).select("*", salt).hint("merge").join(salted, ["hash", "_salt"])
              .groupBy("key").agg(F.collect_set(F.struct("hash", "place")).alias("found")))
    affected, affected_path = written(_texts(docs, text_col, min(length, 2 * words - 1) if words else length).join(places, "key").dropDuplicates(["key"]), "texts")
    members, members_path = written(members_of(affected, length, gram), "members")
    # What a step leaves is written before the next begins, so its tables can go.
    spans, spans_path = written(repeated_spans(members, length, gram, hot_rows), "spans")
    discard(docs, shared_path, members_path)
    by_text = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    paths = [surveyed_path, affected_path, spans_path]
    if words:
        found, found_path = written(word_members(affected, words), "runs")
        word_spans, path = written(repeated_words(found, words), "word-spans")
        discard(docs, found_path)
        paths.append(path)
        spans = spans.withColumn("_words", F.lit(False)).union(word_spans.withColumn("_words", F.lit(True)))
        span = F.struct("start", "end")
        by_text = spans.groupBy("key").agg(F.collect_list(F.when(~F.col("_words"), span)).alias("spans"),
                                           F.collect_list(F.when(F.col("_words"), span)).alias("word_spans"))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        spans = [[(s["start"], s["end"]) for s in found] for found in batch.column("spans").to_pylist()]
        if words:
            data, offsets = utf8_buffer(batch.column("text"))
            of_words = batch.column("word_spans").to_pylist()
            for a, b in pieces(offsets):
                local = offsets[a:b + 1] - offsets[a]
                w = Words(data[offsets[a]:offsets[b]], local)
                for i in range(b - a):
                    start, end = w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]]
                    spans[a + i] += [(int(start[s["start"]] - local[i]), int(end[s["end"] - 1] - local[i])) for s in of_words[a + i]]
        runs = [merged(s) for s in spans]
        texts = batch.column("text").to_pylist()
        kept = [_cut(text, r) for text, r in zip(texts, runs)]
        out = [_run_lists(runs), pa.array(kept, type=pa.binary())]
        if words:
            byte_runs = [merged([(s["start"], s["end"]) for s in found]) for found in batch.column("spans").to_pylist()]
            out += [_run_lists(byte_runs), pa.array([hashlib.sha256(_cut(t, r)).hexdigest() for t, r in zip(texts, byte_runs)]),
                    _run_lists([merged([(s["start"], s["end"]) for s in found]) for found in batch.column("word_spans").to_pylist()])]
        return out

    spans_type = "array<struct<start:bigint,end:bigint>>"
    made = f"runs {spans_type}, kept binary" + (f", byte_runs {spans_type}, byte_sha256 string, word_runs {spans_type}" if words else "")
    cuts = map_batches(affected.select("key", "text").join(by_text, "key"), run, made, keep=["key"])
    counts = surveyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    documents = surveyed.select("doc_id", "key", "n_bytes", "n_words", "sha256").join(counts, "key")
    return documents, cuts, paths


def op3_repeats_bwt(spark, sf_dir: str) -> DataFrame:
    """What every document loses to repeated strings of 400 bytes, and beside it the words of it (n_words_repeated) that lie in runs of
    51 words or more that occur more than once, however few bytes they have, and the number of such runs (n_word_runs)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    documents, cuts, paths = find_repeats(docs, words=WORDS)

    def covered(runs: str) -> Column:
        return F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    cuts = cuts.select("key", covered("byte_runs").alias("_lost"), F.size("byte_runs").cast("bigint").alias("_runs"),
                       F.col("byte_sha256").alias("_kept"), covered("word_runs").alias("_words"), F.size("word_runs").cast("bigint").alias("_word_runs"))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    copied_words = (F.col("copies") > 1) & (F.col("n_words") >= WORDS)
    out = documents.join(cuts, "key", "left").select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("_lost", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1).cast("bigint")).otherwise(F.coalesce("_runs", F.lit(0))).alias("n_spans"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("_kept", "sha256")).alias("kept_sha256"),
        F.when(copied_words, F.col("n_words").cast("bigint")).otherwise(F.coalesce("_words", F.lit(0))).alias("n_words_repeated"),
        F.when(copied_words, F.lit(1).cast("bigint")).otherwise(F.coalesce("_word_runs", F.lit(0))).alias("n_word_runs"))
    result, _ = written(out, "repeats")
    discard(docs, *paths)
    return result


def remove_repeats(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text_col``; all rows and columns stay.

    Bytes of a character that a cut splits go too, so the text stays valid UTF-8.  A text whose copies make it repeated
    as a whole becomes empty.
    """
    long_enough = F.col("n_bytes") >= options.get("length", LENGTH)
    if options.get("words"):
        long_enough |= F.col("n_words") >= options["words"]
    keyed = map_batches(docs, lambda batch: [_key_column(batch.column(text_col))], "_key binary")
    documents, cuts, _ = find_repeats(docs.withColumn("_row", F.lit(0).cast("bigint")), id_col="_row", text_col=text_col, **options)
    whole = documents.where(F.col("copies") > 1).where(long_enough).select(F.col("key").alias("_key")).distinct()
    change = cuts.select(F.col("key").alias("_key"), F.col("kept").alias("_kept")).join(whole, "_key", "left_anti").union(
        whole.select("_key", F.lit(b"").alias("_kept")))
    joined = keyed.join(change, "_key", "left")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        kept = batch.column("_kept").to_pylist()
        texts = batch.column(text_col).to_pylist()
        return [pa.array([t if k is None else k.decode("utf-8", "ignore") for t, k in zip(texts, kept)], type=pa.string())]

    return map_batches(joined, run, f"`{text_col}` string").select(*[F.col(f"`{c}`") for c in docs.columns])


def _key_column(column: pa.Array) -> pa.Array:
    data, offsets = utf8_buffer(column)
    raw, bounds = data.tobytes(), offsets.tolist()
    return pa.array([_key(raw[a:b]) for a, b in zip(bounds, bounds[1:])], type=pa.binary())
