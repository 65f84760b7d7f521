"""Dropout is drawn anew for every document and every occurrence of a word."""

import random

import numpy as np

from tests.llm.test_merge_dropout import PATH, TABLES, plain_merge, texts
from textlab.llm import merge_dropout
from textlab.llm.merge_dropout import Encoder, encode, merge_words
from textlab.llm.textkit import mix64


def segmentations(raw, word):
    """Ids of the single words of a text that repeats ``word``: a word begins with a piece that has the blank mark."""
    out = []
    for i in np.frombuffer(raw, "<i4").tolist():
        if TABLES.pieces[i].startswith("▁"):
            out.append([])
        out[-1].append(i)
    assert all("".join(TABLES.pieces[i] for i in s) == "▁" + word for s in out)
    return {tuple(s) for s in out}


def test_occurrences_differ_inside_a_document():
    raw = Encoder(TABLES, 0.1).encode([" ".join(["international"] * 500)], [1])[0]
    assert len(segmentations(raw, "international")) > 10


def test_documents_differ(spark):
    df = spark.createDataFrame([(i, "international") for i in range(300)] + [(None, "international"), (None, "internationally")], "doc_id long, text string")
    rows = encode(df, PATH).where("doc_id is not null").collect()
    assert len({tuple(r["ids"]) for r in rows}) > 10


def test_remembered_equal_plain_agenda(monkeypatch):
    """What is remembered by (word, dropped merges) equals merging every occurrence with its own key, in any chunks."""
    rng = random.Random(4)
    words = ["the", "tokenization", "Übung", "don't", "日本語é", "", "a▁b", "aaaaaaa", "x" * 40, "internationalization" * 2, "\x00", "😀ing"]
    some = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(30)] + texts(6, 40)
    encoder = Encoder(TABLES, 0.3, 9)
    got = encoder.encode(some, list(range(len(some))))
    monkeypatch.setattr(merge_dropout, "CHUNK_WORDS", 7)
    assert Encoder(TABLES, 0.3, 9, memo_words=5).encode(some[::-1], list(range(len(some)))[::-1]) == got[::-1]
    monkeypatch.setattr(merge_dropout, "MEMO_SYMBOLS", 0)  # nothing is remembered
    assert Encoder(TABLES, 0.3, 9).encode(some, list(range(len(some)))) == got


def test_possible_merges_cover_the_agenda():
    """Dropping none of a word's possible merges gives the undropped ids, whatever else the key would drop."""
    rng = random.Random(5)
    words = [" " + "".join(rng.choice(["the", "ing", "a", "é", "tion", "日", "er"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    keys = mix64(np.arange(7, 307, dtype=np.uint64))
    dropped, offsets = merge_words(TABLES, *TABLES.symbols(words), keys, 0.05)
    plain, bounds = merge_words(TABLES, *TABLES.symbols(words), keys, 0.0)
    same = 0
    for i, w in enumerate(words):
        merges = merge_dropout.possible_merges(TABLES, w)
        if merges is None:
            continue
        places = mix64(np.array([b << 42 ^ m << 21 ^ e for b, m, e in merges], dtype=np.uint64))
        if not (mix64(keys[i] + places) < np.uint64(int(0.05 * 2.0 ** 64))).any():
            same += 1
            assert dropped[offsets[i]:offsets[i + 1]].tolist() == plain[bounds[i]:bounds[i + 1]].tolist()
        with np.errstate(over="ignore"):
            assert dropped[offsets[i]:offsets[i + 1]].tolist() == plain_merge(TABLES.symbols([w])[0].tolist(), keys[i], 0.05)
    assert same > 30
