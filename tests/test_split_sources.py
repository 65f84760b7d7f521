"""Large single files spread over tasks."""

import io
import json
import os
import random
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.operators.labels import annotation_labels
from textlab.sources import io as IO
from textlab.sources import split as SP

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()),
                       T.StructField("more", T.ArrayType(T.StructType([T.StructField("x", T.StringType())])))])


def nasty(seed, n):
    rng = random.Random(seed)
    parts = ['"', "\\", "{", "}", "[", "]", "\n", "é", "漢", "a", " ", '\\"', "\\\\"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
    return [{"id": i, "t": text(), "more": [{"x": text()} for _ in range(rng.randrange(3))]} for i in range(n)]


def test_records_are_found_at_every_block_size(spark, tmp_path):
    rows = nasty(1, 60)
    want = {(r["id"], r["t"], tuple(m["x"] for m in r["more"])) for r in rows}
    for form, text in (("array", " \n" + json.dumps(rows, ensure_ascii=False, indent=1)), ("lines", "\n".join(map(json.dumps, rows)))):
        d = tmp_path / form
        d.mkdir()
        (d / "a.json").write_text(text, encoding="utf-8")
        (d / "none.json").write_text("")
        (d / "empty.json").write_text("[]")
        for size in (7, 64, 1000, 1 << 20):
            got = SP.read_json_records(spark, str(d), SCHEMA, block_bytes=size).collect()
            assert len(got) == 60 and all(r["_rescued"] is None for r in got), (form, size)
            assert {(r["id"], r["t"], tuple(m["x"] for m in r["more"])) for r in got} == want, (form, size)


def test_one_file_is_read_by_several_tasks_and_broken_records_are_kept(spark, tmp_path):
    good = [json.dumps({"id": i, "t": "x" * 50, "more": []}) for i in range(500)]
    good[100] = '{"id": 100, "t": oops}'
    good[200] = '{"id": "no number", "t": "y"}'
    (tmp_path / "a.json").write_text("[" + ",\n".join(good) + "]")
    df = SP.read_json_records(spark, str(tmp_path), SCHEMA, block_bytes=1000).cache()
    bad = df.filter(F.col("_rescued").isNotNull())
    assert df.count() == 500 and sorted(r["_rescued"] for r in bad.collect()) == sorted([good[100], good[200]])
    assert df.select(F.spark_partition_id()).distinct().count() > 3
    (tmp_path / "a.json").write_text('[{"id": 1, "t": "a", "more": []}, {"id": 2, "t": "never closed')
    got = SP.read_json_records(spark, str(tmp_path), SCHEMA, block_bytes=16).collect()
    assert sorted((r["id"], r["_rescued"] is None) for r in got if r["id"] == 1) == [(1, True)] and len(got) == 2
    assert [r["_rescued"] for r in got if r["_rescued"]] == ['{"id": 2, "t": "never closed']


def test_split_export_equals_the_whole_reader(spark, tmp_path):
    rows = [{"data": {"title": f"T{i}", "id_hash": f"h{i}"},
             "annotations": [{"result": [{"value": {"choices": ["yes" if i % 3 else "no"]}}]}]} for i in range(50)]
    (tmp_path / "export.json").write_text(json.dumps(rows))
    whole = IO.read_annotation_export(spark, str(tmp_path))
    split = IO.read_json_records(spark, str(tmp_path), IO.EXPORT_SCHEMA, block_bytes=300)
    assert sorted(annotation_labels(split).collect()) == sorted(annotation_labels(whole).collect())


def test_members_of_one_archive_run_in_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(os.path.join(tmp_path, "a.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(200):
            z.writestr(f"part{k:03}.csv", f"id,v\n{k:05},a\n{k + 1000:05},\n")
        z.writestr("notes.txt", "no")
    df = IO.read_archive_members(spark, str(tmp_path), "id string, v string").cache()
    assert sorted(r["id"] for r in df.collect()) == sorted(f"{k + o:05}" for k in range(200) for o in (0, 1000))
    assert df.filter("v is null").count() == 200
    assert df.select(F.spark_partition_id()).distinct().count() > 3


def test_parquet_members(spark, tmp_path):
    with zipfile.ZipFile(os.path.join(tmp_path, "a.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(3):
            buf = io.BytesIO()
            pd.DataFrame({"id": range(k * 100, k * 100 + 100), "v": ["x"] * 100}).to_parquet(buf, row_group_size=10)
            z.writestr(f"p{k}.parquet", buf.getvalue())
    got = IO.read_archive_members(spark, str(tmp_path), "id long, v string", "*.parquet", "parquet")
    assert sorted(r["id"] for r in got.collect()) == list(range(300))
