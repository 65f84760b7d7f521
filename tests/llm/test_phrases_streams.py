import random
import re
from collections import Counter

import numpy as np

from textlab.llm import phrases_streams as P

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, words int"
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute(texts, most_words, min_count, top):
    """The contract by counters in one process."""
    f, n = Counter(), Counter()
    for t, lang in texts:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {(g, p): a for (g, p), a in f.items() if len(p) > 1 and a >= min_count}
    dead = set()
    for (g, p), a in found.items():
        for m in range(2, len(p)):
            for x in range(len(p) - m + 1):
                if 100 * a >= 100 * f[g, p[x:x + m]]:
                    dead.add((g, p[x:x + m]))
    out = {}
    for (g, p), a in found.items():
        if (g, p) not in dead:
            cuts = [(1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            out.setdefault(g, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((g, i, p.decode(), -a, l, r, n[g], -s) for g, rows in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force_with_edges(spark):
    rng = random.Random(5)
    vocab = ["the", "The", "of", "new", "york", "city", "é", "日本", "a-b", "x y", "ß"]
    texts = [(rng.choice([" ", "  ", "\t"]).join(rng.choice(vocab) + rng.choice(["", "", "", ".", ",", "\n", " ! "])
                                                  for _ in range(rng.randrange(0, 60))), rng.choice(["en", "de", None, "und"]))
             for _ in range(300)]
    texts += [(None, "en"), ("", None), ("...", "en"), ("new york city hall", "en")] + [("one two three four five six", "fr")] * 30
    texts += [("a " * 50_000 + "b", "long"), ("word" * 300_000, "long")]
    df = spark.createDataFrame([(1, t, g, 3, "p", 9) for t, g in texts], SCHEMA).repartition(3)
    for top in (2000, 5):
        assert rows_of(P.collocations(df, min_count=4, top=top)) == brute(texts, 5, 4, top)
    assert P.collocations(df.limit(0), min_count=4).collect() == []
    assert P.collocations(df, min_count=10**9).collect() == []


def test_exact_beyond_64_bits(spark):
    a, n = 999_999_999_989, 98_765_432_109_876
    stream = spark.createDataFrame([("en", 1, "x", a + 12_345), ("en", 1, "y", a + 99_999_999), ("en", 2, "x y", a)],
                                   "lang string, words int, phrase string, n long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    (r,) = P.estimates(stream, totals).collect()
    assert 1000 * a * n > 1 << 64 and r["score"] == 1000 * a * n // ((a + 12_345) * (a + 99_999_999))


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    texts = [(" ".join(f"w{random.Random(i).randrange(40)}" for i in range(j, j + 30)), "en") for j in range(120)]
    df = spark.createDataFrame([(1, t, g, 3, "p", 9) for t, g in texts], SCHEMA)
    want = brute(texts, 5, 3, 2000)
    assert rows_of(P.collocations(df, min_count=3)) == want
    monkeypatch.setattr(P, "bloom_of", lambda p, c: P.Bloom(13, np.full(1 << 7, -1)))
    assert rows_of(P.collocations(df, min_count=3)) == want
