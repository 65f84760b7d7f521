"""Consolidation figures (FIXTURES §3), rebuilt from the coder joint table."""

from pyspark.sql import functions as F

from textlab.operators import labels as L
from tests.test_golden_agreement import JOINT


def _rounds(spark):
    rows, oid = [], 0
    for c1, c2, ex, n in JOINT:
        for _ in range(n):
            rows += [(f"id{oid}", c1, 1), (f"id{oid}", c2, 2), (f"id{oid}", ex, 3)]
            oid += 1
    return spark.createDataFrame(rows, "id_hash string, label bigint, round int")


def test_keep_last_with_manual_positives(spark):
    rounds = _rounds(spark)
    original = rounds.filter("round = 3").select("id_hash", "label")
    majority = L.majority_label(rounds, "id_hash", "label")
    equal = L.unanimous_label(rounds, "id_hash", "label")
    assert (original.count(), original.filter("label = 1").count()) == (306, 85)
    assert (majority.count(), majority.filter("label = 1").count()) == (306, 69)
    assert (equal.count(), equal.filter("label = 1").count()) == (253, 48)
    # Four manual positives; one of them is already present in original and
    # majority (negative in both) but not in the unanimous set.
    cand = (majority.filter("label = 0").join(original.filter("label = 0"), "id_hash", "left_semi")
            .join(equal, "id_hash", "left_anti").orderBy("id_hash").first().id_hash)
    manual = spark.createDataFrame([(cand, 1), ("m1", 1), ("m2", 1), ("m3", 1)], "id_hash string, label bigint")
    out = {n: L.override_union([df, manual.select("id_hash", "label")], "id_hash")
           for n, df in (("original", original), ("majority", majority), ("equal", equal))}
    assert (out["original"].count(), out["original"].filter("label = 1").count()) == (309, 89)
    assert (out["majority"].count(), out["majority"].filter("label = 1").count()) == (309, 73)
    assert (out["equal"].count(), out["equal"].filter("label = 1").count()) == (257, 52)
    attached = L.attach_label_variants(out["original"].select("id_hash"),
                                       {k: v for k, v in out.items()}, key="id_hash")
    assert attached.count() == 309
    assert attached.filter(F.col("label_equal").isNull()).count() == 52
    assert L.duplicate_keys(attached, "id_hash").count() == 0
