import hashlib
import random
from collections import Counter

import pytest

from textlab.llm import repeats_bwt
from textlab.llm.repeats_bwt import find_repeats, merged, remove_repeats


def brute(texts, length):
    """(n_removed, n_spans, kept bytes) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        runs = merged([(i, i + length) for i in range(len(r) - length + 1) if seen[r[i:i + length]] > 1])
        out.append((sum(b - a for a, b in runs), len(runs), repeats_bwt._cut(r, runs)))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdé \n") for _ in range(n))

    passages = [noise(rng.randint(30, 130)) for _ in range(6)]
    texts = ["", None, "ab" * 90, "a" * 200, "xyz" * 10]
    for _ in range(60):
        texts.append("".join(noise(rng.randint(0, 60)) + rng.choice(passages + [""]) for _ in range(rng.randint(1, 4))))
    for i in range(12):  # one passage in many texts, cut differently
        texts.append(noise(15) + passages[0][i:] + noise(15))
    return texts + texts[7:12] + [texts[9]]


@pytest.mark.parametrize("seed,hot", [(1, 10**6), (2, 10**6), (3, 4)])
def test_equals_brute_force(spark, seed, hot):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    documents, cuts, _ = find_repeats(df, length=40, gram=20, hot_rows=hot)
    cut = {bytes(r["key"]): r for r in cuts.collect()}
    want = brute(texts, 40)
    rows = documents.collect()
    assert len(rows) == len(texts)
    for r in rows:
        n_removed, n_spans, kept = want[r["doc_id"]]
        c = cut.get(bytes(r["key"]))
        if r["copies"] > 1 and r["n_bytes"] >= 40:
            assert n_removed == r["n_bytes"]
        elif c is None:
            assert n_removed == 0 and hashlib.sha256(kept).hexdigest() == r["sha256"]
        else:
            assert (sum(s["end"] - s["start"] for s in c["runs"]), len(c["runs"]), bytes(c["kept"])) == (n_removed, n_spans, kept)
    got = {r["doc_id"]: r["text"] for r in remove_repeats(df, length=40, gram=20).collect()}
    for i, t in enumerate(texts):
        assert (got[i] or "") == want[i][2].decode("utf-8", "ignore")


def test_query_columns_and_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = repeats_bwt.op3_repeats_bwt(spark, str(tmp_path))
    assert got.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and got.count() == 0


def test_query_on_table(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute([r["text"] for r in texts], 400)
    got = {r["doc_id"]: r for r in repeats_bwt.op3_repeats_bwt(spark, sf_dir).collect()}
    assert len(got) == len(texts) and sum(w[0] for w in want) > 0
    for r, (n_removed, n_spans, kept) in zip(texts, want):
        g = got[r["doc_id"]]
        assert (g["n_removed"], g["n_spans"], g["kept_sha256"]) == (n_removed, n_spans, hashlib.sha256(kept).hexdigest())
