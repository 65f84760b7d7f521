"""Cases that earlier rounds got wrong: lost rows, hidden errors, cut recursions."""

import zipfile

import pytest
from pyspark.sql import functions as F

from textlab.functions import text as T
from textlab.functions.tokens import tokens
from textlab.operators import knn as KN
from textlab.operators import labels as L
from textlab.operators import splits as SP
from textlab.sources import io as IO


def test_item_without_annotations_keeps_a_row(spark):
    rows = [({"title": "a", "id_hash": "1"}, []), ({"title": "b", "id_hash": "2"}, None),
            ({"title": "c", "id_hash": "3"}, [{"result": [{"value": {"choices": ["yes"]}}]}])]
    df = spark.createDataFrame(rows, IO.EXPORT_SCHEMA)
    got = {r["id_hash"]: r["label"] for r in L.annotation_labels(df).collect()}
    assert got == {"1": None, "2": None, "3": 1}


def test_strict_tokens_detach_punctuation(spark):
    df = spark.createDataFrame([("Bildung, Demokratie. und „Vielfalt“! (z.B. ESF+) aus-",)], "text string")
    assert df.select(tokens("text", strict=True)).first()[0] == ["bildung", "demokratie", "und", "vielfalt"]


def test_inline_tags_do_not_split_words(spark):
    df = spark.createDataFrame([("<p>De<b>mo</b>kratie</p><p>x</p>",)], "h string")
    assert df.select(T.html_to_text("h")).first()[0] == "Demokratie x"


def test_section_words_strip_newlines(spark):
    df = spark.createDataFrame([("\n\t Kurztext rest\n",)], "t string")
    assert df.select(T.strip_section_words("t")).first()[0].strip() == "rest"


def test_smote_with_few_minority_rows(spark):
    rows = [(i, [float(i), 0.0], 1 if i < 4 else 0) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert KN.smote(df, "vec_id", "embedding", "label", k=5).count() == 22
    with pytest.raises(ValueError):
        KN.smote(df.where("vec_id = 0 or label = 0"), "vec_id", "embedding", "label", k=5)


def test_valuation_finds_flipped_labels(spark):
    rows = [(i, [float(i % 2) * 10 + (i % 17) / 17, (i % 5) / 5], int(i % 2 == 0) ^ int(i in (4, 7))) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ranks = KN.valuation_ranks(5, 0.05)
    val = KN.knn_shapley(df, KN.knn(df, "vec_id", "embedding", k=ranks), "vec_id", "label", k=5, ranks=ranks)
    low = [r["vec_id"] for r in val.orderBy("data_valuation_score").limit(2).collect()]
    assert sorted(low) == [4, 7] and val.where("data_valuation_score < 0.5").count() >= 2


def test_results_log_raises_other_errors(spark, tmp_path):
    assert IO.read_results(spark, str(tmp_path / "none")).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        IO.read_results(spark, str(bad)).count()


def test_archive_ids_keep_zeros(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "id_hash,label\n00123,1\n00124,\n")
    got = IO.read_archive_members(spark, str(tmp_path), "id_hash string, label long").collect()
    assert sorted((r["id_hash"], r["label"]) for r in got) == [("00123", 1), ("00124", None)]


def test_cached_folds_hold_augmented_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"Titel ({'Förderbereich'}: a; {'Förderberechtigte'}: b): text {i} words here", i % 2) for i in range(20)],
                                 "doc_id long, text string, label int")
    plain = SP.cached_folds(docs, "doc_id", "label", "text", str(tmp_path), 2)
    more = SP.cached_folds(docs, "doc_id", "label", "text", str(tmp_path), 2, augment_factor=2)
    again = SP.cached_folds(docs, "doc_id", "label", "text", str(tmp_path), 2, augment_factor=2)
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, again.collect()))
    added = more.where("round > 0")
    assert plain.count() == 40 and added.where("role <> 'train'").count() == 0
    parents = added.select("fold", "doc_id").join(plain.where(F.col("role") == "test").select("fold", "doc_id"), ["fold", "doc_id"])
    assert parents.count() == 0
