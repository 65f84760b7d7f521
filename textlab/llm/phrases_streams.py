"""Collocated phrases by sorted count streams.

Counting.  Each task turns its texts into words and pieces (numpy on the UTF-8 buffer), gives words numbers by an exact dictionary of the
batch and numbers longer phrases as pairs (number of the phrase without its last word, last word), so a batch counts its phrases by sorting
integers.  The partial counts are summed by Spark and written as one count stream per length, without those under ``MIN_COUNT``.
A phrase is as rare as its rarest part, so only runs of frequent pairs are counted, and only pairs of frequent words are tried as such.
The frequent words, then pairs, reach the tasks as a Bloom filter.  Pairs are tried under a 64-bit key of their words; a pair that
shares the key or the filter's bits of others is counted word by word afterwards and dropped like any other rare phrase, so
no result depends on keys or filters.

Estimation layout.  The streams are kept in two orders: by phrase (prefix order: a phrase lies next to its longer phrases to the right)
and by reversed phrase (suffix order: next to those to the left).  In each order neighbouring lengths are read in lockstep by sort-merge
joins: a phrase's left parts come from the stream of shorter phrases as prefixes, its right parts as suffixes, and the greatest
counts of its one-word extensions from the stream of longer ones.  No hash table of phrases is built.  An extension by several words
that is as frequent as the phrase has one by one word that is, so one word on either side is enough.

Scale: three passes over the texts, each column-pruned; partial counts are combined in the batch, in the task and then by
phrase, so a very frequent phrase is one row a task.  Streams hold phrases with at least ``MIN_COUNT`` occurrences only.  The
filters (``bloom``) have at most 16 MB, whatever the input.

Defined cases: a null text is empty; a null language is ``und``; empty tables and texts without a frequent phrase give no
rows; repeated rows count each; ties in the score are ordered by count and phrase; other columns do not enter, and clashing names are not
read; texts are handled in pieces of ``PIECE_BYTES``, a longer text is a piece of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlab.llm.bloom import Bloom, bloom_of
from textlab.llm.tables import discard, written
from textlab.llm.textkit import mix64, pieces, prefix_hash, span_hash, utf8_buffer

MIN_COUNT = 100
MOST_WORDS = 5
TOP = 2000
PIECE_BYTES = 4 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_COUNTS = "lang string, words int, phrase string, n long"


def _word_hashes(words: pa.Array) -> np.ndarray:
    data, offsets = utf8_buffer(words)
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    for a, b in pieces(offsets):
        at = offsets[a:b + 1] - offsets[a]
        out[a:b] = span_hash(prefix_hash(data[offsets[a]:offsets[b]]), at[:-1], at[1:])
    return out


def _keys(lang: np.ndarray, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """64-bit keys of words or pairs, from the hashes of their words and the number of their language."""
    both = first if second is None else first * np.uint64(0x9E3779B97F4A7C15) + mix64(second)
    return mix64(both ^ lang)


def _lang_numbers(langs: pa.Array) -> np.ndarray:
    return mix64(_word_hashes(langs) + np.uint64(1))


def _key_column(keys: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(keys).view(np.int64))


def word_keys(words: DataFrame) -> DataFrame:
    """The keys of the phrases (lang, phrase) of one word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([_key_column(_keys(_lang_numbers(b.column(0)), _word_hashes(b.column(1))))], names=["key"])

    return words.select("lang", "phrase").mapInArrow(run, "key long")


class _Piece:
    """Words of some texts: ``id`` into ``dictionary`` (sorted out exactly), ``lang`` numbers, and ``ends``: no phrase goes on
    from word i to word i + 1."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray):
        n = len(data)
        gap = _GAP[data]
        solid = ~gap
        starts, stops = solid.copy(), np.zeros(n + 1, dtype=bool)
        starts[1:] &= gap[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts[first] = solid[first]
        stops[1:] = solid
        stops[1:n] &= gap[1:]
        last = offsets[1:][offsets[:-1] < offsets[1:]]
        stops[last] = solid[last - 1]
        start, stop = np.flatnonzero(starts), np.flatnonzero(stops)
        row = np.searchsorted(offsets, start, side="right") - 1
        self.lang = lang[row]
        breaks = np.cumsum(_BREAK[data], dtype=np.int32 if n < 1 << 31 else np.int64)[start]
        self.ends = np.ones(len(start), dtype=bool)
        self.ends[:-1] = (np.diff(breaks) != 0) | (np.diff(row) != 0)
        ends = np.concatenate([[0], np.cumsum(stop - start)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(_LOWERED[data[solid]])])
        coded = words.dictionary_encode()
        self.id = coded.indices.to_numpy().astype(np.int64)
        self.dictionary = coded.dictionary


def _phrases(piece: _Piece, at: np.ndarray, words: int) -> pa.Array:
    parts = [piece.dictionary.take(pa.array(piece.id[at + j])) for j in range(words)]
    if words == 1:
        return parts[0].cast(pa.large_string())
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())


def _known_pairs(piece: _Piece, langs: np.ndarray, words: Bloom) -> np.ndarray:
    """The keys of all pairs of known words, one an occurrence."""
    hashes = _word_hashes(piece.dictionary)
    known = words.has(_keys(langs[piece.lang], hashes[piece.id]))
    at = np.flatnonzero(~piece.ends[:-1] & known[:-1] & known[1:])
    return _keys(langs[piece.lang[at]], hashes[piece.id[at]], hashes[piece.id[at + 1]])


def _count_words(piece: _Piece) -> tuple[np.ndarray, np.ndarray]:
    _, at, n = np.unique((piece.id << 16) | piece.lang, return_index=True, return_counts=True)
    return at, n


def _count_phrases(piece: _Piece, langs: np.ndarray, most_words: int, pairs: Bloom) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, places of one occurrence of each distinct phrase, its count) for 2 to ``most_words`` words of known pairs."""
    at = np.flatnonzero(~piece.ends)
    hashes = _word_hashes(piece.dictionary)
    at = at[pairs.has(_keys(langs[piece.lang[at]], hashes[piece.id[at]], hashes[piece.id[at + 1]]))]
    good = np.zeros(len(piece.id) + 1, dtype=bool)
    good[at] = True
    # number[i]: the phrase of size - 1 words at i, the same for equal ones; at first the word and its language.
    number = np.zeros(len(piece.id) + 1, dtype=np.int64)
    number[at] = np.unique((piece.id[at] << 16) | piece.lang[at], return_inverse=True)[1]
    for size in range(2, most_words + 1):
        if size > 2:
            at = at[~piece.ends[at + size - 2] & good[at + size - 2]]
        if not len(at):
            return
        _, one, which, n = np.unique((number[at] << 32) | piece.id[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
        yield size, at[one], n
        number[at] = which


def _rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").cast("string").alias("t"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("g"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Piece, pa.Array, np.ndarray]]:
    """The pieces of the texts, the names of their languages and the numbers of these."""
    for batch in batches:
        data, offsets = utf8_buffer(batch.column(0))
        coded = batch.column(1).dictionary_encode()
        lang, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        numbers = _lang_numbers(names)
        for a, b in pieces(offsets, PIECE_BYTES):
            yield _Piece(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lang[a:b]), names, numbers


def word_counts(docs: DataFrame, **columns: str) -> DataFrame:
    """(lang, words = 1, phrase, n), and for each language a row with phrase null: the number of all its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, names, _ in _pieces(batches):
            at, n = _count_words(piece)
            yield _batch(names.take(pa.array(piece.lang[at])), 1, _phrases(piece, at, 1), n)
            yield _batch(names, 1, pa.nulls(len(names), pa.string()), np.bincount(piece.lang, minlength=len(names)))

    return _rows(docs, **columns).mapInArrow(run, _COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def pair_keys(docs: DataFrame, words: Bloom, min_count: int, **columns: str) -> DataFrame:
    """(key, n) of the pairs of known words with at least ``min_count`` occurrences under their key."""
    share = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, numbers in _pieces(batches):
            keys, n = np.unique(_known_pairs(piece, numbers, share.value), return_counts=True)
            yield pa.RecordBatch.from_arrays([_key_column(keys), pa.array(n.astype(np.int64))], names=["key", "n"])

    return _rows(docs, **columns).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def phrase_counts(docs: DataFrame, pairs: Bloom, most_words: int, **columns: str) -> DataFrame:
    """(lang, words, phrase, n) of the phrases of 2 to ``most_words`` words whose pairs are all known."""
    share = docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, names, numbers in _pieces(batches):
            for words, at, n in _count_phrases(piece, numbers, most_words, share.value):
                yield _batch(names.take(pa.array(piece.lang[at])), words, _phrases(piece, at, words), n)

    return _rows(docs, **columns).mapInArrow(run, _COUNTS).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def _batch(lang: pa.Array, words: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), pa.array(np.full(len(n), words, dtype=np.int32)),
                                       phrase.cast(pa.string()), pa.array(n.astype(np.int64))], names=["lang", "words", "phrase", "n"])


def count_streams(docs: DataFrame, most_words: int = MOST_WORDS, min_count: int = MIN_COUNT, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``most_words`` words with at least ``min_count`` occurrences, (lang, words, phrase, n), and all words of each
    language, (lang, n)."""
    ones, _ = written(word_counts(docs, **columns).where((F.col("n") >= min_count) | F.col("phrase").isNull()), "phrases-words")
    words = ones.where("phrase IS NOT NULL")
    keys, keys_path = written(pair_keys(docs, bloom_of(word_keys(words), "key"), min_count, **columns).select("key"), "phrases-keys")
    pairs = bloom_of(keys, "key")
    discard(keys, keys_path)
    longer, _ = written(phrase_counts(docs, pairs, most_words, **columns).where(F.col("n") >= min_count), "phrases-longer")
    return words.unionByName(longer), ones.where("phrase IS NULL").select("lang", "n")


def _reversed(phrase: Column) -> Column:
    return F.array_join(F.reverse(F.split(phrase, " ")), " ")


def estimates(stream: DataFrame, totals: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """Candidates that no longer candidate stands for: lang, phrase, words, a, l, r, n, score."""
    # Suffix order sorts by the reversed words, so a phrase's right parts are its prefixes there.
    prefix = stream.select("lang", "words", F.col("phrase").alias("key"), "n")
    suffix = stream.select("lang", "words", _reversed(F.col("phrase")).alias("key"), "n")
    space = F.lit(" ")

    def parts(order: DataFrame) -> DataFrame:
        """For each phrase the counts of its first parts in this order: array by length."""
        long_ = order.where("words > 1")
        cut = long_.select("lang", "key", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
        cut = cut.withColumn("part", F.expr("substring_index(key, ' ', cut)"))
        short = order.where(F.col("words") < most_words).select(F.col("lang").alias("_l"), F.col("key").alias("_k"), F.col("n").alias("part_n"))
        met = cut.join(short.hint("merge"), (F.col("lang") == F.col("_l")) & (F.col("part") == F.col("_k")))
        return met.groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("cut", "part_n"))).alias("parts"))

    def longest(order: DataFrame) -> DataFrame:
        """For each phrase the greatest count of a phrase with one more word in this order."""
        more = order.where("words > 2").select("lang", F.expr("substring_index(key, ' ', words - 1)").alias("key"), "n")
        return more.groupBy("lang", "key").agg(F.max("n").alias("more"))

    def lockstep(order: DataFrame) -> DataFrame:
        both = order.where("words > 1").join(parts(order).hint("merge"), ["lang", "key"])
        return both.join(longest(order).hint("merge"), ["lang", "key"], "left").drop("cut")

    left = lockstep(prefix).select("lang", "words", F.col("key").alias("phrase"), F.col("n").alias("a"),
                                   F.col("parts").alias("lefts"), F.col("more").alias("more_right"))
    right = lockstep(suffix).select("lang", _reversed(F.col("key")).alias("phrase"), F.col("parts").alias("rights"), F.col("more").alias("more_left"))
    both = left.join(right.hint("merge"), ["lang", "phrase"])
    whole = totals.select("lang", F.col("n").alias("n"))
    both = both.join(whole, "lang").where("100 * coalesce(more_right, 0) < 100 * a AND 100 * coalesce(more_left, 0) < 100 * a")
    # lefts[k - 1] has the first k words, rights[words - k - 1] the last words - k.
    scored = both.withColumn("cuts", F.expr("""transform(sequence(1, words - 1), k -> struct(
        (cast(1000 AS decimal(38,0)) * a * n) div (cast(lefts[k - 1].part_n AS decimal(19,0)) * rights[words - k - 1].part_n) AS score,
        k AS cut, lefts[k - 1].part_n AS l, rights[words - k - 1].part_n AS r))""")).withColumn("best", F.array_min("cuts"))
    return scored.select("lang", "phrase", "words", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
                         F.col("best.score").alias("score"))


def top_phrases(found: DataFrame, top: int = TOP, salts: int = 256) -> DataFrame:
    """Each language's first ``top`` rows with their rank; first within ``salts`` parts of a language, then among what they keep."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    kept = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    return (kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top).drop("_part"))


def collocations(docs: DataFrame, most_words: int = MOST_WORDS, min_count: int = MIN_COUNT, top: int = TOP, **columns: str) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score."""
    stream, totals = count_streams(docs, most_words, min_count, **columns)
    return top_phrases(estimates(stream, totals, most_words), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases_streams(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return collocations(docs).withColumn("rank", F.col("rank").cast("bigint"))


SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, w, i, unnest(range(1, least({MOST_WORDS}, len(w) - i + 1) + 1)) AS k FROM starts),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
scored AS (SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.a AS l, r.a AS r, t.n, (1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a) AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ') JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, array_to_string(w[x:x + m - 1], ' ') AS phrase, max(a) AS more FROM
    (SELECT lang, w, k, a, x, unnest(range(2, k)) AS m FROM (SELECT *, unnest(range(1, k)) AS x FROM c)) WHERE x + m - 1 <= k GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score::BIGINT AS score
FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
WHERE more IS NULL OR 100 * more < 100 * a QUALIFY rank <= {TOP}"""
