"""Sources and sinks round-trip."""

import io
import json
import os
import tempfile
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from textlab.operators.labels import annotation_labels
from textlab.sources import io as IO


def test_annotation_export_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tl-io-")
    rows = [
        {"data": {"title": "A", "id_hash": "h1"}, "annotations": [{"result": [{"value": {"choices": ["yes"]}}]}]},
        {"data": {"title": "B", "id_hash": "h2"}, "annotations": [{"result": [{"value": {"choices": ["dfn"]}}]}]},
        {"data": {"title": "C", "id_hash": "h3"}, "annotations": [{"result": [{"value": {"choices": []}}]}]},
        {"data": {"title": "D", "id_hash": "h4"}, "annotations": [
            {"result": [{"value": {"choices": ["no"]}}]}, {"result": [{"value": {"choices": ["dfy", "no"]}}]}]},
    ]
    with open(os.path.join(d, "export.json"), "w") as fh:
        json.dump(rows, fh)
    got = {(r.id_hash, r.label) for r in annotation_labels(IO.read_annotation_export(spark, d)).collect()}
    assert got == {("h1", 1), ("h2", 0), ("h3", None), ("h4", 0), ("h4", 1)}


def test_label_csv_and_writers(spark):
    d = tempfile.mkdtemp(prefix="tl-io-")
    with open(os.path.join(d, "labels.csv"), "w") as fh:
        fh.write("id_hash,label\nx,1\ny,0\nx,1\n")
    df = IO.read_label_csv(spark, d + "/labels.csv")
    assert df.count() == 3 and dict(df.dtypes)["label"] == "bigint"
    IO.write_parquet(df, d + "/p")
    assert spark.read.parquet(d + "/p").count() == 3
    arr = df.withColumn("tags", F.array(F.lit("a"), F.lit("b")))
    IO.write_csv(arr, d + "/c")
    back = spark.read.option("header", True).csv(d + "/c").collect()
    assert {r.tags for r in back} == {"a,b"}
    IO.write_delivery(df, df.filter("label = 1"), d + "/deliv")
    assert spark.read.option("header", True).csv(d + "/deliv/positive_examples").count() == 2


def test_archive_members(spark):
    d = tempfile.mkdtemp(prefix="tl-zip-")
    for k in range(2):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr("data.csv", pd.DataFrame({"id": [k * 10 + i for i in range(5)], "v": ["a"] * 5}).to_csv(index=False))
            z.writestr("readme.txt", "skip me")
        with open(os.path.join(d, f"a{k}.zip"), "wb") as fh:
            fh.write(buf.getvalue())
    df = IO.read_archive_members(spark, d, "id long, v string", "*.csv")
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]


def test_results_log_and_params(spark):
    d = tempfile.mkdtemp(prefix="tl-res-") + "/results"
    assert IO.read_results(spark, d).count() == 0
    r = spark.createDataFrame([(0.7, 0.8, 0.6, 0.9, "label", "text", "rules")],
                              "f1 double, precision double, recall double, accuracy double, label_col string, "
                              "text_col string, experiment string")
    IO.append_results(r, d)
    IO.append_results(r, d)
    log = IO.read_results(spark, d)
    assert log.count() == 2 and log.filter(F.col("run_at").isNull()).count() == 0
    p = tempfile.mkdtemp(prefix="tl-par-") + "/params"
    IO.save_params(spark, {"min_df": 1, "threshold": 0.47}, p)
    assert IO.load_params(spark, p) == {"min_df": 1, "threshold": 0.47}
