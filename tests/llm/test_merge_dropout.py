import random

import numpy as np
import public_tokenizers
import sentencepiece

from textlab.llm.merge_dropout import Decoder, Encoder, PieceTables, decode, encode, op8_merge_dropout
from textlab.llm.textkit import mix64

PATH = public_tokenizers.path("piece_bpe_32k.model")
TABLES = PieceTables(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(encoder, text, variant=0):
    return np.frombuffer(encoder.encode([text], [variant])[0], "<i4").tolist()


def texts(seed, n=300):
    rng = random.Random(seed)
    bits = ["hello", "Übung", " ", "  ", "   ", "\n", "don't", "1.25", "\t", "日本語", "é", "aaaaaaa", "tokenization", ".", "<s>", "😀", " the", "\x00"]
    return ["", " ", "x", "a  b", "  lead", "trail  "] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 20))) for _ in range(n)]


def test_without_dropout_equals_the_library(sf_dir):
    encoder = Encoder(TABLES, rate=0.0)
    import pyarrow.parquet as pq
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column(0).to_pylist()[:60]
    for t in texts(1) + table:
        assert ids(encoder, t) == LIBRARY.encode(t), repr(t[:80])


def plain_merge(symbols, key, rate):
    """Agenda processing of one word, one candidate at a time."""
    pairs = {int(k): (int(r), int(p)) for k, r, p in zip(TABLES.pair_key, TABLES.pair_rank, TABLES.pair_piece)}
    s = [(x, i, i + 1) for i, x in enumerate(symbols)]
    while True:
        best = None
        for i in range(len(s) - 1):
            found = pairs.get(s[i][0] * TABLES.size + s[i + 1][0])
            place = np.uint64((s[i][1] << 42) ^ (s[i][2] << 21) ^ s[i + 1][2])
            if found and int(mix64(np.array([key + mix64(np.array([place]))[0]], dtype=np.uint64))[0]) >= int(rate * 2.0 ** 64):
                if best is None or found[0] < best[0]:
                    best = (found[0], i, found[1])
        if best is None:
            return [x[0] for x in s]
        i = best[1]
        s[i:i + 2] = [(best[2], s[i][1], s[i + 1][2])]


def test_dropout_equals_plain_agenda():
    from textlab.llm.merge_dropout import merge_words
    rng = random.Random(2)
    words = [" " + "".join(rng.choice(["the", "ing", "a", "é", "zz", "tion", "日", "  "]) for _ in range(rng.randint(1, 7))) for _ in range(60)]
    keys = mix64(np.arange(1, 61, dtype=np.uint64))
    got, offsets = merge_words(TABLES, *TABLES.symbols(words), keys, 0.3)
    with np.errstate(over="ignore"):
        for w, key, a, b in zip(words, keys, offsets, offsets[1:]):
            assert got[a:b].tolist() == plain_merge(TABLES.symbols([w])[0].tolist(), key, 0.3), w


def test_lossless_varied_and_repeatable():
    a, b, decoder = Encoder(TABLES, 0.3, 5), Encoder(TABLES, 0.3, 5, memo_words=3), Decoder(TABLES)
    differ = 0
    for t in texts(3) + ["a▁b", "▁", "mixed ▁ mark"]:
        one, two = ids(a, t, 1), ids(a, t, 2)
        assert one == ids(b, t, 1)
        assert decoder.decode(one) == t == decoder.decode(two)
        differ += one != two
        if "▁" not in t and "\x00" not in t:
            assert LIBRARY.decode(one) == t
    assert differ > 100


def test_frames(spark, sf_dir):
    rows = [(1, "a  word\n", "x"), (1, "a  word\n", "x"), (None, None, None), (2, "", ""), (3, "long word " * 20000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode(df, PATH)
    back = decode(got.drop("text"), PATH).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back if r["text"] is not None) == sorted((r[0] or -1, r[1]) for r in rows if r[1] is not None)
    assert [r["ids"] for r in got.where("doc_id is null").collect()] == [None]
    assert encode(df.limit(0), PATH).count() == 0
    full = op8_merge_dropout(spark, sf_dir)
    assert full.where("not lossless").count() == 0 and full.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
