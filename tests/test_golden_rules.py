"""Golden figures for rules and objectives (FIXTURES §4)."""

import pytest
from pyspark.sql import functions as F

from textlab.operators import rules as R
from textlab.operators.evaluate import recall_first_objective


def test_score_formula_values(spark):
    # A term seen p times in positives and n in negatives scores p / (p + n + 1).
    rows = []
    i = 0
    for p, n, term in [(34, 0, "polit"), (22, 0, "demokrati"), (20, 0, "bekampf"), (19, 0, "leb"), (17, 0, "inklusion")]:
        for _ in range(p):
            rows.append((i, 1, [term]))
            i += 1
    for _ in range(40):
        rows.append((i, 0, ["anders"]))
        i += 1
    docs = spark.createDataFrame(rows, "doc_id long, label int, tokens array<string>")
    rules = {r.pattern: r.score for r in R.mine_rules(docs, min_df=3, max_features=1000, threshold=0.94,
                                                       ngram_range=(1, 1)).collect()}
    assert rules["polit"] == pytest.approx(34 / 35, abs=1e-6)
    assert rules["demokrati"] == pytest.approx(22 / 23, abs=1e-6)
    assert rules["bekampf"] == pytest.approx(20 / 21, abs=1e-6)
    assert rules["leb"] == pytest.approx(0.95, abs=1e-6)
    assert rules["inklusion"] == pytest.approx(17 / 18, abs=1e-6)
    assert "anders" not in rules


def test_recall_first_objective_value(spark):
    df = spark.createDataFrame([(0.948148, 0.583598)], "r double, p double")
    v = df.select(recall_first_objective(F.col("r"), F.col("p")).alias("o")).first().o
    assert v == pytest.approx(0.689259, abs=1e-6)


def test_min_df_and_cap_within_class(spark):
    # A term cut from the negative vocabulary (below min_df there) counts as 0.
    rows = [(i, 1, ["x"]) for i in range(10)] + [(100, 0, ["x"]), (101, 0, ["y"]), (102, 0, ["y"])]
    docs = spark.createDataFrame(rows, "doc_id long, label int, tokens array<string>")
    r = {x.pattern: (x.pos, x.neg) for x in R.mine_rules(docs, min_df=2, max_features=10, threshold=0.5,
                                                          ngram_range=(1, 1)).collect()}
    assert r == {"x": (10, 0)}
