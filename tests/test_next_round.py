"""The predictions behind a sample are made once."""

from pyspark.sql import functions as F

from textlab.operators.report import next_round_sample


def test_predictions_are_made_once(spark):
    """Before, every row was predicted four times or more: to count, to return and twice to rank."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def predict(i):
        made.add(1)
        return int(i % 5 == 0)

    out = next_round_sample(spark.range(0, 40, 1, 2).select(F.col("id").alias("doc_id"), predict("id").alias("pred")), seed=42).collect()
    assert made.value == 40
    assert sorted(r["doc_id"] for r in out if r["stratum"] == "predicted_positive") == list(range(0, 40, 5))
    drawn = [r["doc_id"] for r in out if r["stratum"] == "sampled_negative"]
    assert len(set(drawn)) == len(drawn) == 8 and all(i % 5 for i in drawn)
