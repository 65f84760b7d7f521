import re
from collections import Counter, defaultdict
from fractions import Fraction

from textlab.llm import mix_schedule as X

SCHEMA = "doc_id long, text string, source string, size int, slot string, _at int"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def targets(sizes):
    """The contract's targets by resharing, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        out = {s: Fraction(2 * sizes[s]) if s in full else left * weight[s] / open_ for s in order}
        above = {s for s in order if out[s] > 2 * sizes[s]}
        if not above:
            return out
        full |= above


def check(schedule, rows, texts, block):
    sizes = Counter()
    for _, t, s in texts:
        sizes[s] += len(words(t))
    want = targets(sizes)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d, len(words(t))) for d, t, _ in texts)
    taken = Counter()
    for p in schedule:
        taken[p["_at"]] += p["length"]
    by_source = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - float(want[r["source"]])) < 1e-6
        assert taken[r["_at"]] <= 2 * r["size"]
        by_source[r["source"]] += taken[r["_at"]]
    for s in sizes:
        assert by_source[s] == int(want[s])
    slots = defaultdict(list)
    for p in schedule:
        assert 0 <= p["start"] and p["length"] > 0
        slots[p["slot"]].append(p)
    filled = Counter()
    for pieces in slots.values():
        assert len({p["source"] for p in pieces}) == 1, "a slot takes one block of one source"
        n = sum(p["length"] for p in pieces)
        assert n <= block
        filled[pieces[0]["source"]] += n < block
        at = min(p["at"] for p in pieces)
        for p in sorted(pieces, key=lambda p: p["at"]):
            assert p["at"] == at
            at += p["length"]
    assert all(n <= 1 for n in filled.values()), "only a source's last block is short"
    return slots, want


def run(df, block):
    schedule, rows = X.mix(df, block)
    return schedule.collect(), rows.collect()


def test_edges_and_hot_source(spark):
    texts = [(i, "a b\tc\nd " * (i % 7), "hot") for i in range(300)]
    texts += [(1000 + i, "é w", f"s{i}") for i in range(6)] + [(None, None, None), (None, "x y z", None), (7, "", "s0")]
    texts += [(5, "same text", "rep")] * 40 + [(5, "same other", "rep")] * 3 + [(2000, "w " * 30_000, "long"), (1, "a", ""), (2, None, "empty")]
    df = spark.createDataFrame([(d, t, s, 1, "c", 3) for d, t, s in texts], SCHEMA).repartition(5)
    schedule, rows = run(df, 16)
    slots, want = check(schedule, rows, texts, 16)
    again = run(df.repartition(3), 16)
    assert sorted((p["slot"], p["at"], p["doc_id"] or -1, p["start"], p["length"]) for p in again[0]) == sorted(
        (p["slot"], p["at"], p["doc_id"] or -1, p["start"], p["length"]) for p in schedule)
    assert run(df.limit(0), 16) == ([], [])
    one = run(df.where("source = ''"), 16)
    check(*one, [(1, "a", "")], 16)


def test_every_stretch_has_the_target_shares(spark):
    texts = [(i, "w " * 20, s) for s, n in (("a", 500), ("b", 100), ("c", 300), ("d", 300)) for i in range(n)]
    schedule, rows = run(spark.createDataFrame([(d, t, s, 1, "c", 3) for d, t, s in texts], SCHEMA), 8)
    slots, want = check(schedule, rows, texts, 8)
    order = [slots[k][0]["source"] for k in sorted(slots)]
    total = sum(want.values())
    for at in range(0, len(order) - 128, 64):
        found = Counter(order[at:at + 128])
        assert all(abs(found[s] - 128 * float(want[s] / total)) < 10 for s in want), (at, found)


def test_table_and_texts(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    schedule, rows = run(docs, X.BLOCK_WORDS)
    check(schedule, rows, texts, X.BLOCK_WORDS)
    got = X.op12_mix_schedule(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() == len(texts)
    X.write_mix(docs, str(tmp_path / "mix"))
    text = {d: words(t) for d, t, _ in texts}
    back = {(r["slot"], r["at"]): r for r in spark.read.parquet(str(tmp_path / "mix")).collect()}
    assert len(back) == len(schedule)
    for p in schedule:
        r = back[p["slot"], p["at"]]
        assert r["text"].split(" ") == text[p["doc_id"]][p["start"]:p["start"] + p["length"]]
