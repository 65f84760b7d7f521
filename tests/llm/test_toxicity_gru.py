import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlab.llm import toxicity_gru as G
from textlab.llm.textkit import utf8_buffer


def test_gradients_equal_finite_differences():
    data, offsets = utf8_buffer(pa.array(["this is a bad lowei text " * 6, "nice words here only", "x", "", "good " * 40]))
    y = np.array([1, 0, 0, 0, 1])
    inputs = G.Inputs(data, offsets)
    parts = G.start_parts(inputs, y, dtype=np.float64)
    _, start, text = G.window_margins(parts, inputs)
    weight = np.ones(len(start))

    def loss():
        return G.loss_and_gradients(parts, inputs, start, text, y[text], weight)

    _, gradients = loss()
    rng = np.random.default_rng(0)
    for name, value in parts.items():
        at = np.argwhere(np.abs(gradients[name]) > 1e-9)
        for place in at[rng.permutation(len(at))[:5]]:
            place, old, e = tuple(place), value[tuple(place)], 1e-5
            value[place] = old + e
            up = loss()[0]
            value[place] = old - e
            down = loss()[0]
            value[place] = old
            assert (up - down) / (2 * e) == pytest.approx(gradients[name][place], rel=1e-3, abs=1e-8)


def test_windows_cover_all_words_and_do_not_depend_on_neighbours():
    texts = ["a b c", "w " * 100 + "last", "", "one"]
    data, offsets = utf8_buffer(pa.array(texts))
    inputs = G.Inputs(data, offsets)
    start, text = inputs.windows()
    tokens, mask = inputs.tokens(start, text)
    covered = {int(s) + j for s, m in zip(start, mask) for j in np.flatnonzero(m)}
    assert covered == set(range(3 + 101 + 1)) and set(text.tolist()) == {0, 1, 3}
    parts = G.start_parts(inputs, np.array([1, 0, 0, 0]))
    together = G.text_margins(parts, data, offsets)
    for i, t in enumerate(texts):
        assert G.text_margins(parts, *utf8_buffer(pa.array([t])))[0] == pytest.approx(together[i], abs=1e-4)


def plain_margin(parts, text):
    """The greatest margin of a text's windows, one step at a time."""
    def sigmoid(v):
        return 1 / (1 + np.exp(-v))

    def vector(word):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        data, offsets = utf8_buffer(pa.array([word.decode()]))
        bucket = int(G.Words(data, offsets).hash[0] % np.uint64(G.BUCKETS))
        marked = [0] + [b + 1 for b in low] + [0]
        marked += [0] * max(0, G.GRAM - len(marked))
        runs = []
        for i in range(len(marked) - G.GRAM + 1):
            value = 0
            for b in marked[i:i + G.GRAM]:
                value = (value * 257 + b) % 2 ** 64
            runs.append(parts["grams"][int(G.mix64(np.array([value], dtype=np.uint64))[0] % np.uint64(G.BUCKETS))])
        return np.concatenate([parts["words"][bucket], np.mean(runs, axis=0)])

    words, h = text.encode().split(), G.HIDDEN
    best, at = -np.inf, 0
    while at == 0 or at + G.WINDOW - G.STRIDE < len(words):
        xs = [vector(w) for w in words[at:at + G.WINDOW]]
        both = []
        for d in "fb":
            state, states = np.zeros(h), []
            for x in xs if d == "f" else xs[::-1]:
                gx, gh = x @ parts[f"w{d}"] + parts[f"b{d}"], state @ parts[f"u{d}"]
                r, z = sigmoid(gx[:h] + gh[:h]), sigmoid(gx[h:2 * h] + gh[h:2 * h])
                new = np.tanh(gx[2 * h:] + r * gh[2 * h:])
                state = (1 - z) * new + z * state
                states.append(state)
            both.append(states if d == "f" else states[::-1])
        full = [np.concatenate(p) for p in zip(*both)]
        weight = np.exp([s @ parts["attend"] for s in full])
        best = max(best, sum(a * s for a, s in zip(weight / weight.sum(), full)) @ parts["out"] + parts["bias"][0])
        at += G.STRIDE
    return best


def test_margins_equal_a_plain_loop():
    rng = np.random.default_rng(5)
    pool = ["a", "It", "idiot", "Straße", "été", "wordofsixteen", "x.y", "WORTHLESS"]
    texts = [" ".join(rng.choice(pool, n)) for n in (1, 2, 23, 24, 25, 36, 37, 60, 121)]
    data, offsets = utf8_buffer(pa.array(texts))
    parts = G.start_parts(G.Inputs(data, offsets), np.arange(len(texts)) % 2, dtype=np.float64)
    got = G.text_margins(parts, data, offsets)
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain_margin(parts, t), rel=1e-5, abs=1e-6)


def test_runs_are_cut_at_character_bounds():
    texts = ["天気がいいから散歩に行きましょう" * 300, "é" * 999, "short words only", "a" + "ß" * G.LONGEST, "b" * 3_000_000]
    data, offsets = utf8_buffer(pa.array(texts))
    words = G.Words(data, offsets)
    start, end = G.cut_runs(data, words.start, words.end)
    for a, b, n in zip(words.start, words.end, np.searchsorted(start, words.start)):
        m = np.searchsorted(start, b)
        assert start[n] == a and end[m - 1] == b and (start[n + 1:m] == end[n:m - 1]).all()
    assert (end - start).max() <= G.LONGEST + 3 and (end > start).all()
    for a, b in zip(start[:2000].tolist(), end[:2000].tolist()):
        data[a:b].tobytes().decode()
    assert len(G.Inputs(data, offsets).windows()[0]) > len(data) // (G.LONGEST * G.STRIDE) - 5


def test_toxic_passage_in_a_long_text_without_blanks():
    rng = np.random.default_rng(7)
    syllables, bad = ["la", "ou", "er", "th", "in", "on", "re", "ti"], ["disgusting", "pathetic", "worthless", "stupid"]
    texts, y = [], np.arange(300) % 3 == 0
    for toxic in y:
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(rng.integers(30, 120))]
        for _ in range(4 * toxic):
            words.insert(rng.integers(len(words)), str(rng.choice(bad)))
        texts.append(" ".join(words))
    net = G.train(*utf8_buffer(pa.array(texts)), y.astype(np.int64), 1 / 3)
    clean = "".join(rng.choice(syllables, 50_000))
    data, offsets = utf8_buffer(pa.array([clean, clean[:50_000] + "".join(bad) * 3 + clean[50_000:], texts[0], texts[1]]))
    chance = G._sigmoid(net.slope * G.text_margins(net.parts, data, offsets) + net.offset)
    assert (chance >= G.SCORE_CUT).tolist() == [False, True, True, False]


def test_held_texts_give_no_ratios_and_the_curve_does_not_swing():
    data, offsets = utf8_buffer(pa.array(["bad one", "fine one", "bad two", "fine two", "held word"]))
    inputs, y = G.Inputs(data, offsets), np.array([1, 0, 1, 0, 1])
    use = np.arange(5) < 4
    parts = G.start_parts(inputs, y, use=use)
    bucket = inputs.word_bucket[inputs.word_of]
    assert parts["words"][bucket[-2:], 0].tolist() == [0, 0] and parts["words"][bucket[0], 0] > 0 > parts["words"][bucket[2], 0]
    margin = np.concatenate([np.full(60, -9.0), np.full(20, 12.0), np.full(6, -8.0), np.full(3, 11.0)])
    labels = np.concatenate([np.zeros(60), np.ones(20), np.ones(6), np.zeros(3)]).astype(int)
    slope, offset = G.logistic_curve(margin, labels, labels.mean())
    chance = G._sigmoid(slope * margin + offset)
    assert chance[0] == pytest.approx(6 / 66, abs=0.03) and chance[60] == pytest.approx(20 / 23, abs=0.06)


def test_held_out_accuracy_and_edges(spark, sf_dir):
    got = G.op1_toxicity_gru(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out and toxic is not null")
    r = got.agg(F.avg(F.expr("double(predicted = toxic)")).alias("right"), F.min("score").alias("a"), F.max("score").alias("b")).first()
    assert r["right"] > 0.85 and 0 <= r["a"] <= r["b"] <= 1
    rows = got.select("score", "toxic", "predicted").toPandas()
    toxic, said = rows["toxic"] == 1, rows["predicted"] == 1
    rank = rows["score"].rank()
    auc = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    f1 = 2 * (toxic & said).sum() / (toxic.sum() + said.sum())
    assert auc > 0.8 and f1 > 0.5


def test_edge_rows(spark):
    rows = [(1, "bad scum here", "q"), (1, "bad scum here", "q"), (2, None, None), (3, "", ""), (None, "x " * 30000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    one_class = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    both = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (2, 0)], "doc_id long, toxic int")
    assert {r["score"] for r in G.score(docs, G.fit(docs, one_class)).collect()} == {1.0}
    assert {r["score"] for r in G.score(docs, G.fit(docs, one_class.limit(0))).collect()} == {0.0}
    got = G.score(docs, G.fit(docs, both))
    assert got.dtypes[-1] == ("score", "double") and got.count() == 5 and G.score(docs.limit(0), G.fit(docs, both)).count() == 0
