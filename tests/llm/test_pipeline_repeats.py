"""The pipeline's repeats stage cuts repeated runs of more than 50 words, however few bytes they have."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm.test_repeats_bwt import brute as brute_bytes
from textlab.llm.repeats_bwt import _cut, merged


def brute(texts, words=51, length=400):
    """Texts without strings of ``length`` bytes and runs of ``words`` words that occur more than once."""
    raw = [t.encode() for t in texts]
    spans = [[] for _ in raw]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    split = []
    for r in raw:
        at, found = 0, []
        for word in r.split():
            at = r.index(word, at)
            found.append((word, at, at + len(word)))
            at += len(word)
        split.append(found)
    runs = Counter(tuple(w[0] for w in f[i:i + words]) for f in split for i in range(len(f) - words + 1))
    for r, f, s in zip(raw, split, spans):
        s += [(i, i + length) for i in range(len(r) - length + 1) if seen[r[i:i + length]] > 1]
        s += [(f[i][1], f[i + words - 1][2]) for i in range(len(f) - words + 1) if runs[tuple(w[0] for w in f[i:i + words])] > 1]
    return [_cut(r, merged(s)).decode("utf-8", "ignore") for r, s in zip(raw, spans)]


def corpus(rng):
    def noise(n):
        return " ".join(f"{rng.choice('abcé')}{rng.randrange(10**5)}" for _ in range(n))

    def short(n):
        return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    passages = [noise(51), noise(50), short(51), short(60), short(50), noise(120)]
    texts = []
    for p in passages:
        texts += [f"{noise(rng.randint(0, 90))} {p} {noise(rng.randint(0, 90))}" for _ in range(3)]
    texts.append(noise(20) + "\n" + passages[0].replace(" ", "  \n") + " " + noise(9))  # other white space
    texts += [" ".join(passages[3].split()[k:]) + " " + noise(70) for k in range(12)]  # cut differently
    texts += [noise(30), "", "go " * 70, short(55), "long" * 150 + noise(3), noise(2) + " " + "long" * 150]
    return passages, texts


def test_planted_passages(spark):
    passages, texts = corpus(random.Random(7))
    assert len(passages[0].encode()) < 400 and len(passages[2].encode()) == 101
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.repeats(spark, df, "").collect()}
    want = brute(texts)
    assert [got[i]["text"] for i in range(len(texts))] == want
    assert [got[i]["n_chars"] for i in range(len(texts))] == [len(t) for t in want]
    kept = " ".join(want)
    assert [p in kept for p in passages] == [False, True, False, False, True, False]


def test_copies_of_short_texts(spark):
    """Copies of 51 words and under 400 bytes go as a whole; those of 50 words stay."""
    rng = random.Random(8)
    a, b = (" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (51, 50))
    df = spark.createDataFrame([(1, a), (2, a), (3, b), (4, b), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeats(spark, df, "").collect()}
    assert got == {1: "", 2: "", 3: b, 4: b, 5: None}


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").dropDuplicates(["text"]).where("text is not null")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip((r["doc_id"] for r in rows), brute([r["text"] for r in rows])))
    assert sum(want[r["doc_id"]] != k.decode("utf-8", "ignore") for r, (_, _, k) in zip(rows, brute_bytes([r["text"] for r in rows], 400))) > 0
    frozen = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.repeats(spark, frozen, sf_dir).collect()} == want


def test_query_counts_repeated_words(spark, sf_dir):
    """The query's word columns: the words in runs of 51 or more that occur more than once."""
    from textlab.llm.repeats_bwt import WORDS, op3_repeats_bwt
    docs = {r["doc_id"]: (r["text"] or "").encode().split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen = Counter(tuple(w[i:i + WORDS]) for w in docs.values() for i in range(len(w) - WORDS + 1))
    for r in op3_repeats_bwt(spark, sf_dir).collect():
        w = docs[r["doc_id"]]
        spans = merged([(i, i + WORDS) for i in range(len(w) - WORDS + 1) if seen[tuple(w[i:i + WORDS])] > 1])
        assert (r["n_words_repeated"], r["n_word_runs"]) == (sum(b - a for a, b in spans), len(spans))
