import hashlib
import random

import numpy as np

from textlab.llm import fingerprints_oph as P
from tests.llm.test_near_dups import shingles


def test_estimate_is_close_to_jaccard():
    rng = random.Random(1)
    errors = []
    for _ in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([12, 60, 600]))]
        keep = rng.random()
        other = base[:int(len(base) * keep)] + [f"v{rng.randrange(10**6)}" for _ in range(int(len(base) * rng.random()) + 5)]
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        values = P.fingerprints(*P._column([" ".join(base), " ".join(other)]))
        errors.append(float(P.likeness(values[:1], values[1:])[0]) - len(a & b) / len(a | b))
    assert np.mean(np.abs(errors)) < 0.05 and abs(np.mean(errors)) < 0.03


def test_densification_fills_from_the_first_non_empty_bin():
    least = np.array([[5, 9, 9, 9], [1, 2, 3, 4]], dtype=np.uint64)
    empty = np.array([[False, True, True, True], [False] * 4])
    assert P.densified(least, empty).tolist() == [[5, 5, 5, 5], [1, 2, 3, 4]]


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else P._LEAST), (r[1] or "").encode()))
    out = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        edited = P.edited_text(t, after)
        values = P.fingerprints(*P._column([t, edited, after]))
        prints = P.packed(values)
        out.append((-1 if d is None else d, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1],
                    round(float(P.likeness(values[:1], values[1:2])[0]), 9), round(float(P.likeness(values[:1], values[2:])[0]), 9)))
    return sorted(out)


def result(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                   round(r["near_edited"], 9), round(r["near_next"], 9)) for r in P.compare_with_next(df).collect())


def test_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(docs) == brute(rows)


def test_edge_rows(spark):
    rows = [(3, "é b c d e f g"), (3, "é b c d e f g"), (None, None), (None, "zz"), (7, ""), (1, "  "), (9, "x " * 40000)]
    df = spark.createDataFrame([(d, t, "f", "r") for d, t in rows], "doc_id long, text string, fingerprint string, _range string")
    assert result(df) == brute(rows)
    assert result(df.limit(1)) == brute(rows[:1]) and result(df.limit(0)) == []
