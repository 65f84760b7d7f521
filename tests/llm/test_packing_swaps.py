import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textlab.llm.bpe_ids import WordIds
from textlab.llm.packing_swaps import best_fit_decreasing, cut_points, local_search, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer():
    ours = WordIds(open(PATH, encoding="utf-8").read(), memo_words=50)
    rng = random.Random(3)
    bits = ["word", "Übung", " ", "  ", "\n", "don't", "x1.2", "\t", "<|endoftext|>", "日本", " ", "!!", "a", "'s", " 's", "\x1c", " "]
    for _ in range(800):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(ours.ids(t), "<u4").tolist() == PLAIN.encode(t, add_special_tokens=False).ids, repr(t)


def test_cut_points():
    assert cut_points(1, 4) == [(0, 1)] and cut_points(4, 4) == [(0, 4)]
    assert cut_points(9, 4) == [(0, 1), (1, 4), (5, 4)] and cut_points(8, 4) == [(0, 4), (4, 4)]


def test_local_search_empties_a_bin():
    # Best-fit decreasing needs 4 bins here; 3 are enough.
    rng = random.Random(1)
    better = 0
    for _ in range(200):
        lengths = np.array(sorted((rng.randint(15, 60) for _ in range(30)), reverse=True))
        bins = best_fit_decreasing(lengths, 100)
        out = local_search([list(b) for b in bins], lengths, 100)
        assert sorted(i for b in out for i in b) == list(range(30))
        assert all(lengths[b].sum() <= 100 for b in out) and len(out) <= len(bins)
        better += len(out) < len(bins)
    assert better > 0


def test_documents(spark, sf_dir):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (3, "", None), (None, "null id", "y"), (4, "long words here " * 3000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    docs = docs.unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("piece", F.lit("p")))
    got = pack_documents(docs, PATH).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    want = []
    for d, t in texts:
        ids = PLAIN.encode(t, add_special_tokens=False).ids + [2]
        for p, (s, n) in enumerate(cut_points(len(ids), 1024)):
            want.append((-1 if d is None else d, p, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = np.array(sorted((r["length"] for r in got), reverse=True))
    assert len(bins) <= len(best_fit_decreasing(lengths, 1024))
    assert len(bins) <= 1.005 * math.ceil(lengths.sum() / 1024)
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_repeated_rows_spread_over_the_groups(spark):
    rows = [(1, "same text")] * 10_000 + [(None, None)] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = pack_documents(docs, PATH, group_rows=1000).collect()
    assert len(got) == 13_000
    groups = Counter(r["sequence_id"] >> 32 for r in got)
    assert len(groups) == 13 and max(groups.values()) < 2500
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == [sum(n for _, n in items[:k]) for k in range(len(items))]
        assert sum(n for _, n in items) <= 1024


def _fewest(lengths, capacity):
    """The least number of bins, by trying every place."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= lengths[k]:
                left = list(rooms)
                left.remove(r)
                place(k + 1, left + [r - lengths[k]])
        place(k + 1, rooms + [capacity - lengths[k]])

    place(0, [])
    return best


def test_number_of_bins_against_every_packing():
    rng = random.Random(8)
    exact = 0
    for _ in range(120):
        lengths = np.array(sorted((rng.randint(10, 60) for _ in range(9)), reverse=True))
        out = local_search(best_fit_decreasing(lengths, 100), lengths, 100)
        least = _fewest(lengths.tolist(), 100)
        assert least <= len(out) <= least + 1
        exact += len(out) == least
    assert exact >= 114
