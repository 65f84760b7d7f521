"""The pipeline's stages against brute force on each stage's own input."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_near_dups import brute_classes
from tests.llm.test_pii_anchors import brute as brute_pii
from tests.llm.test_pipeline_repeats import brute as brute_repeats
from textlab.llm.tables import written


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, _ = written(stage(spark, inputs[-1], sf_dir), name)
        assert out.columns == columns and out.dtypes == docs.dtypes
        inputs.append(out)
    rows = [{r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for d in inputs]

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1 and d in rows[0]]
    assert sum(d in rows[1] for d in good) >= 0.95 * len(good)
    assert all(rows[1][d] == rows[0][d] for d in rows[1]) and len(rows[1]) < len(rows[0])

    want = brute_classes(list(rows[1].items()))
    assert set(rows[2]) == {c for _, c in want}

    kept = brute_repeats(list(rows[2].values()), corpus_pipeline.REPEATED_WORDS, 400)
    assert all(rows[3][d] == k for d, k in zip(rows[2], kept))

    assert set(rows[4]) == set(rows[3])
    for d, t in rows[3].items():
        if not brute_pii(t) and "://" not in t:
            assert rows[4][d] == t
        for kind, a, b in brute_pii(t):
            if kind == "email":
                assert t[a:b] not in rows[4][d]

    packed = corpus_pipeline.STAGES[-1][1](spark, inputs[-1], sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows[4].items()}


def test_empty_table(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
