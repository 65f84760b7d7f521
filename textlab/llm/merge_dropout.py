"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A merge-type (BPE) SentencePiece model starts from a text's characters and keeps merging the neighbouring pair whose
union is the best-scored piece, the leftmost of equal ones, until no union of neighbours is a piece.  With dropout, each
candidate merge is decided once, when it comes onto the agenda: a keyed hash of (seed, document, position and bytes of the
word, place of its left, middle and right edge) below ``rate`` skips it for good.  So one key gives one segmentation, on any
machine and in any order of rows, and every occurrence of a word is cut on its own; without dropout the result is the
library's own.  The document enters by its id, or by its text where it has none.

No piece holds a blank mark after another character, so blanks with the word after them segment on their own.  A word's
segmentation depends on nothing but which of its possible merges are dropped.  These are hashed for every occurrence, and
each worker remembers the segmentation of (word, set of dropped merges), bounded; new ones are merged many at a time: every
round makes each word's best remaining merge.  Rare words and those of many symbols or possible merges are merged at every
occurrence.

Characters that are no piece become their bytes' pieces.  The blank mark character itself, if a text holds it, becomes
its bytes too, so decoding always gives back the text.

Scale: encoding and decoding are one scan each; the model's tables (under 5 MB) are broadcast; nothing is shuffled.

Defined cases: null texts give null ids and decode to null, empty ones no ids; repeated rows have equal ids; ties go to
the leftmost pair; an empty table gives an empty result; other columns pass through, one named like an added column is
replaced by it.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.textkit import map_batches, mix64

RATE = 0.1
SEED = 20
MEMO_WORDS = 300_000
BATCH_ROWS = 1024
CHUNK_WORDS = 1 << 15
MEMO_SYMBOLS = 24
LEARN_TIMES = 8
_SLOT_BITS = 20
_BITS = 44  # of a set of dropped merges; the word's number takes the rest
BLANK = "▁"
_NO_PIECE = "\udfff"  # stands for a byte of a character that is no piece
_NONE = np.int64(1) << np.int64(40)


class PieceTables:
    """A model's pieces, byte pieces and merges, as arrays that can be broadcast."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = [0] * 256
        special = set()
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(self.pieces[i][3:-1], 16)] = i
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                special.add(i)
        self.normal = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.longest = max(map(len, self.normal))
        self.single = {p: i for p, i in self.normal.items() if len(p) == 1 and p != BLANK}
        # All pairs of pieces whose union is a piece, in order of their key left * n + right; a better score is a lower rank.
        order = {i: r for r, i in enumerate(sorted(self.normal.values(), key=lambda i: (-model.get_score(i), i)))}
        merges = sorted((self.normal[p[:k]] * n + self.normal[p[k:]], order[i], i) for p, i in self.normal.items()
                        for k in range(1, len(p)) if p[:k] in self.normal and p[k:] in self.normal)
        self.size = n
        self.pair_key = np.array([m[0] for m in merges], dtype=np.int64)
        self.pair_rank = np.array([m[1] for m in merges], dtype=np.int64)
        self.pair_piece = np.array([m[2] for m in merges], dtype=np.int64)
        self.blank_id = self.normal[BLANK]
        # A pair's place by its hash; where hashes meet, the later pairs are found by search.
        self.slot = np.zeros(1 << _SLOT_BITS, dtype=np.int32)
        slots = self._slots(self.pair_key)
        self.slot[slots[::-1]] = np.arange(len(slots), dtype=np.int32)[::-1]
        self.crowded = np.zeros(1 << _SLOT_BITS, dtype=bool)
        self.crowded[slots[self.slot[slots] != np.arange(len(slots))]] = True

        self.of_code = np.full(0x110000, -1, dtype=np.int32)  # symbol of each character that is a piece
        self.of_code[[ord(c) for c in self.single]] = list(self.single.values())
        self.of_code[ord(" ")] = self.blank_id

    @staticmethod
    def _slots(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys among the pairs, and whether they are pairs."""
        slots = self._slots(key)
        at = self.slot[slots]
        found = self.pair_key[at] == key
        unsure = np.flatnonzero(self.crowded[slots] & ~found)
        if len(unsure):
            at[unsure] = np.minimum(np.searchsorted(self.pair_key, key[unsure]), len(self.pair_key) - 1)
            found[unsure] = self.pair_key[at[unsure]] == key[unsure]
        return at, found

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of all words, one after the other (blanks as blank marks), and each word's number of them."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbol = self.of_code[codes]
        other = np.flatnonzero(symbol < 0)
        if len(other):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in codes[other].tolist()]
            times = np.ones(len(codes), dtype=np.int64)
            times[other] = [len(r) for r in raw]
            symbol, word = np.repeat(symbol, times), np.repeat(word, times)
            symbol[symbol < 0] = [self.byte_ids[b] for r in raw for b in r]
        return symbol.astype(np.int64), np.bincount(word, minlength=len(words))


def merge_words(tables: PieceTables, symbol: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all words (given as symbols, ``sizes`` a word), one after the other, and the words' offsets (n + 1).

    ``keys``: the words' hash keys for dropout.
    """
    word = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.arange(len(symbol)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    end = begin + 1
    limit = np.uint64(min(int(rate * 2.0 ** 64), (1 << 64) - 1))
    finished: list[tuple[np.ndarray, np.ndarray]] = []

    def ranks(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the candidate merge of symbols at ``left`` and ``right`` (_NONE: none, or dropped), and its piece."""
        at, is_piece = tables.find(symbol[left] * tables.size + symbol[right])
        is_piece &= word[left] == word[right]
        if rate > 0:
            some = np.flatnonzero(is_piece)
            a, b = left[some], right[some]
            place = (begin[a].astype(np.uint64) << np.uint64(42)) ^ (end[a].astype(np.uint64) << np.uint64(21)) ^ end[b].astype(np.uint64)
            is_piece[some] = mix64(keys[word[a]] + mix64(place)) >= limit
        return np.where(is_piece, tables.pair_rank[at], _NONE), tables.pair_piece[at]

    index = np.arange(len(symbol))
    rank, piece = ranks(index[:-1], index[1:]) if len(symbol) > 1 else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    rank, piece = np.append(rank, _NONE)[:len(symbol)], np.append(piece, 0)[:len(symbol)]
    while len(symbol):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
        going = best < _NONE
        if not going.all():
            finished.append((word[~going], symbol[~going]))
        here = np.flatnonzero((rank == best) & going)
        if len(here):
            here = here[np.append(True, word[here[1:]] != word[here[:-1]])]  # the leftmost
            symbol[here], end[here] = piece[here], end[here + 1]
            going[here + 1] = False
        at = np.cumsum(going) - 1  # places after the cut
        kept = np.flatnonzero(going)
        symbol, word, begin, end, rank, piece = (x.take(kept) for x in (symbol, word, begin, end, rank, piece))
        merged = at[here]
        rank[merged] = _NONE
        # The merged symbols' candidates with both neighbours are new.
        stale = np.zeros(len(symbol) + 1, dtype=bool)
        stale[merged], stale[merged - 1] = True, True
        fresh = np.flatnonzero(stale[:max(len(symbol) - 1, 0)])
        if len(fresh):
            rank[fresh], piece[fresh] = ranks(fresh, fresh + 1)
    if not finished:
        return np.zeros(0, dtype=np.int32), np.zeros(len(sizes) + 1, dtype=np.int64)
    owner, ids = (np.concatenate(x) for x in zip(*finished))
    order = np.argsort(owner, kind="stable")
    return ids[order].astype("<i4"), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])


def possible_merges(tables: PieceTables, word: str) -> list[tuple[int, int, int]] | None:
    """(begin, middle, end) of all merges of ``word``'s symbols that may come onto the agenda under some dropout; None if
    there are too many to remember."""
    symbols = "".join(BLANK if c == " " else c if c in tables.single else _NO_PIECE * len(c.encode("utf-8", "surrogatepass")) for c in word)
    n = len(symbols)
    if n > MEMO_SYMBOLS:
        return None
    reached = {(i, i + 1) for i in range(n)}
    out = []
    for size in range(2, min(n, tables.longest) + 1):
        for b in range(n - size + 1):
            e = b + size
            if symbols[b:e] in tables.normal:
                found = [(b, m, e) for m in range(b + 1, e) if (b, m) in reached and (m, e) in reached]
                if found:
                    reached.add((b, e))
                    out += found
    return out if len(out) <= _BITS else None


class Encoder:
    """``encode(texts, documents)``: ids of each text as bytes (little-endian int32); ``documents`` are the texts' keys."""

    def __init__(self, tables: PieceTables, rate: float = RATE, seed: int = SEED, memo_words: int = MEMO_WORDS):
        self.tables, self.rate, self.seed, self.memo_words = tables, rate, seed, memo_words
        self.limit = np.uint64(min(int(rate * 2.0 ** 64), (1 << 64) - 1))
        # Where the ids of a (word, set of dropped merges) begin among ``ids`` (times 2^32), and how many there are.
        self.memo: dict[int, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.memo.clear()
        self.ids, self.n_ids = np.zeros(8192, dtype="<i4"), 0
        self.number: dict[str, int] = {}
        # Of each word: its hash, how often it came, where its possible merges begin among the places, and how many there
        # are (-1: not known yet, -2: too many).
        self.known: list[str] = []
        self.hash = np.zeros(1024, dtype=np.uint64)
        self.times, self.begin, self.count = (np.zeros(1024, dtype=np.int64) for _ in range(3))
        self.places, self.n_places = np.zeros(8192, dtype=np.uint64), 0

    def _meet(self, words: list[str]) -> None:
        at, n = len(self.known), len(words)
        self.known += words
        self.number.update(zip(words, range(at, at + n)))
        self.hash, self.times, self.begin, self.count = (_room(x, at + n) for x in (self.hash, self.times, self.begin, self.count))
        self.hash[at:at + n] = [zlib.crc32(w) << 32 | zlib.adler32(w) for w in map(str.encode, words)]
        self.count[at:at + n] = -1 if self.rate > 0 else 0

    def _learn(self, numbers: np.ndarray) -> None:
        places, counts = [], []
        for i in numbers.tolist():
            merges = possible_merges(self.tables, " " + self.known[i])
            counts.append(-2 if merges is None else len(merges))
            places += [b << 42 ^ m << 21 ^ e for b, m, e in merges or []]
        self.count[numbers] = counts
        some = np.maximum(self.count[numbers], 0)
        self.begin[numbers] = self.n_places + np.cumsum(some) - some
        self.places = _room(self.places, self.n_places + len(places))
        self.places[self.n_places:self.n_places + len(places)] = mix64(np.array(places, dtype=np.uint64))
        self.n_places += len(places)

    def _parts(self, text: str) -> list[str]:
        """The text's words, each with the blanks before it; the first has the one blank that encoding adds."""
        words = text.split(" ")
        if "" not in words:
            return words
        out, blanks = [], 0
        for i, w in enumerate(words):
            if w or i == len(words) - 1:
                out.append(" " * blanks + w)
                blanks = 0
            else:
                blanks += 1
        return out

    def _pieces(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and each word's number of them; ``keys`` stand for their documents and positions."""
        if len(self.memo) > self.memo_words or len(self.number) > self.memo_words:
            self._forget()
        coded = pa.array(words, pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.number]
        if new:
            self._meet(new)
        number = np.fromiter(map(self.number.__getitem__, distinct), dtype=np.int64, count=len(distinct))[coded.indices.to_numpy()]
        self.times[:len(self.known)] += np.bincount(number, minlength=len(self.known))
        due = np.flatnonzero((self.times[:len(self.known)] >= LEARN_TIMES) & (self.count[:len(self.known)] == -1))
        if len(due):
            self._learn(due)
        keys = mix64(keys + self.hash[number])
        count = np.maximum(self.count[number], 0)
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(words)), count)
        bit = np.arange(len(owner)) - first[owner]
        dropped = np.flatnonzero(mix64(keys[owner] + self.places[self.begin[number][owner] + bit]) < self.limit)
        # Sums of different powers of two below 2^44 are exact.
        mask = np.bincount(owner[dropped], weights=np.exp2(bit[dropped]), minlength=len(words)).astype(np.int64)
        known = self.count[number] >= 0
        learnt, always = np.flatnonzero(known), np.flatnonzero(~known)
        cases, example, case = np.unique(((number << _BITS) | mask)[learnt], return_index=True, return_inverse=True)
        places = list(map(self.memo.get, cases.tolist()))
        missing = np.array([i for i, p in enumerate(places) if p is None], dtype=np.int64)
        todo = np.concatenate([learnt[example[missing]], always])
        made, sizes = [np.zeros(0, dtype="<i4")], [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(todo), 10_000):
            some = todo[at:at + 10_000]
            ids, offsets = merge_words(self.tables, *self.tables.symbols([" " + words[i] for i in some.tolist()]), keys[some], self.rate)
            made.append(ids)
            sizes.append(np.diff(offsets))
        ids, size = np.concatenate(made), np.concatenate(sizes)
        # The ids of what is not remembered stand behind the others for this call.
        self.ids = _room(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        place = (self.n_ids + np.cumsum(size) - size) << 32 | size
        for i, p in zip(missing.tolist(), place.tolist()):
            places[i] = p
        self.memo.update(zip(cases[missing].tolist(), place.tolist()))
        self.n_ids += int(size[:len(missing)].sum())
        of_word = np.empty(len(words), dtype=np.int64)
        of_word[learnt], of_word[always] = np.array(places, dtype=np.int64)[case], place[len(missing):]
        begin, length = of_word >> 32, of_word & 0xFFFFFFFF
        return self.ids[np.arange(length.sum()) + np.repeat(begin - np.cumsum(length) + length, length)], length

    def encode(self, texts: list[str], documents: list[int]) -> list[bytes]:
        split = [self._parts(t) if t else [] for t in texts]
        sizes = np.array([len(parts) for parts in split], dtype=np.int64)
        ends = np.cumsum(sizes)
        document = mix64(np.array([d % (1 << 64) for d in documents], dtype=np.uint64) + np.uint64(self.seed * 1_000_003 % (1 << 64)))
        words = [w for parts in split for w in parts]
        done, lengths = [np.zeros(0, dtype="<i4")], [np.zeros(1, dtype=np.int64)]
        for at in range(0, len(words), CHUNK_WORDS):
            index = np.arange(at, min(at + CHUNK_WORDS, len(words)))
            text = np.searchsorted(ends, index, side="right")
            position = (index - (ends - sizes)[text]).astype(np.uint64)
            ids, length = self._pieces(words[at:at + CHUNK_WORDS], mix64(document[text] + mix64(position)))
            done.append(ids)
            lengths.append(length)
        raw, to = np.concatenate(done).tobytes(), 4 * np.cumsum(np.concatenate(lengths))
        return [raw[a:b] for a, b in zip(to[ends - sizes].tolist(), to[ends].tolist())]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with place for ``size`` values at least."""
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])


class Decoder:
    """``decode(ids)``: the text whose encoding, under any dropout, ``ids`` is."""

    def __init__(self, tables: PieceTables):
        raw = [p.replace(BLANK, " ").encode() for p in tables.pieces]
        for b, i in enumerate(tables.byte_ids):
            raw[i] = bytes([b])
        self.raw = raw

    def decode(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


_WORKER: dict[tuple, Encoder] = {}


def encode(docs: DataFrame, model_path: str, rate: float = RATE, seed: int = SEED, id_col: str = "doc_id",
           text_col: str = "text", keep: list[str] | None = None, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` (array<int>): each whole text's piece ids.  The model file is read on the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(PieceTables(model_path))
    name = (hashlib.sha256(open(model_path, "rb").read()).hexdigest(), rate, seed)
    of_text = F.xxhash64(F.lit("text"), F.col(f"`{text_col}`"), F.lit(seed))
    source = docs.withColumn("_document", F.when(F.col(f"`{id_col}`").isNull(), of_text).otherwise(
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit(seed))))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if name not in _WORKER:
            _WORKER.clear()
            _WORKER[name] = Encoder(shared.value, rate, seed)
        raw: list[bytes] = []
        for a in range(0, batch.num_rows, 256):
            raw += _WORKER[name].encode(batch.column(text_col).slice(a, 256).to_pylist(), batch.column("_document").slice(a, 256).to_pylist())
        offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), dtype="<i4")),
                                         mask=batch.column(text_col).is_null())]

    wanted = [c for c in (keep if keep is not None else docs.columns) if c != "_document"]
    return map_batches(source, run, f"{ids_col} array<int>", keep=wanted, rows=BATCH_ROWS)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``rows`` with ``text_col``: the text of each row's piece ids."""
    shared = rows.sparkSession.sparkContext.broadcast(PieceTables(model_path))
    held: list[Decoder] = []

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if not held:
            held.append(Decoder(shared.value))
        lists = batch.column(ids_col)
        offsets, values, missing = lists.offsets.to_numpy(), lists.values.to_numpy(), lists.is_null().to_pylist()
        return [pa.array([None if none else held[0].decode(values[a:b].tolist())
                          for none, a, b in zip(missing, offsets.tolist(), offsets[1:].tolist())], type=pa.string())]

    return map_batches(rows, run, f"`{text_col}` string", keep=keep, rows=BATCH_ROWS)


def op8_merge_dropout(spark, sf_dir: str) -> DataFrame:
    """Every document's piece ids under merge-dropout, and whether they decode to its text."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    encoded = encode(docs.withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256)), path, keep=["doc_id", "_sha"])
    decoded = decode(encoded, path)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids",
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
                          F.sha2(F.col("text").cast("binary"), 256).eqNullSafe(F.col("_sha")).alias("lossless"))
