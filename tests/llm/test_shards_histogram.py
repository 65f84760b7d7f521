import zlib
from collections import Counter

from textlab.llm.shards_histogram import assign_shards, op6_shards_histogram, write_shards


def check(rows, texts, shards, slack):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    by = {k: [r for r in rows if r["shard"] == k] for k in range(shards)}
    assert sum(map(len, by.values())) == len(rows)
    for k in by:
        assert sorted(r["slot"] for r in by[k]) == list(range(len(by[k])))
    sizes = [sum(r["size"] for r in by[k]) for k in by]
    assert max(sizes) - min(sizes) <= slack, sizes


def test_hot_text_edges_and_balance(spark):
    texts = [(i, "hot text " * 5) for i in range(400)] + [(1000 + i, f"text {i} " * (i % 9)) for i in range(500)]
    texts += [(None, None), (5000, None), (5001, ""), (5002, "x" * 300), (7, "hot text " * 5), (-(1 << 62), "é"), (1 << 62, "é")]
    df = spark.createDataFrame([(d, t, "s", 1) for d, t in texts], "doc_id long, text string, shard string, _hash int")
    rows = assign_shards(df, 8, tolerance=0.01).collect()
    check(rows, texts, 8, 700)
    assert len({r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(("hot text " * 5).encode())}) > 1
    assert assign_shards(df.limit(0), 8).count() == 0
    check(assign_shards(df.limit(1), 8).collect(), [(0, "hot text " * 5)], 8, 100)


def test_one_repeated_row(spark):
    df = spark.createDataFrame([(1, "same")] * 50, "doc_id long, text string")
    check(assign_shards(df, 8).collect(), [(1, "same")] * 50, 8, 5)
    many = [(1, "same")] * 800 + [(i, f"text {i}") for i in range(800)] + [(2, "x" * 3000)]
    df = spark.createDataFrame(many, "doc_id long, text string").repartition(7)
    rows = assign_shards(df, 4, tolerance=0.001).collect()
    check(rows, many, 4, 3001)
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) > 1


def test_table_and_files(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = op6_shards_histogram(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(got.collect(), texts, 8, 2 * max(len((t or "").encode()) + 1 for _, t in texts))
    write_shards(docs, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["doc_id"] for r in back.collect()) == sorted(d for d, _ in texts)
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == {r["doc_id"]: r["shard"] for r in got.collect()}
