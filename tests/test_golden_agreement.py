"""Agreement figures of the reference's coder data, rebuilt from its joint
table of (coder 1, coder 2, expert) -> count (306 items)."""

import pytest
from pyspark.sql import functions as F

from textlab.operators import agreement as A

# Joint counts of coder 1, coder 2 and the expert round.
JOINT = [
    (0, 0, 0, 205), (0, 0, 1, 18), (0, 1, 0, 9), (0, 1, 1, 11),
    (1, 0, 0, 5), (1, 0, 1, 8), (1, 1, 0, 2), (1, 1, 1, 48),
]


@pytest.fixture(scope="module")
def long(spark):
    rows, oid = [], 0
    for c1, c2, ex, n in JOINT:
        for _ in range(n):
            rows += [(1, oid, c1), (2, oid, c2), (3, oid, ex)]
            oid += 1
    return spark.createDataFrame(rows, "rater int, object_id bigint, score int")


@pytest.fixture(scope="module")
def wide(long):
    return A.ratings_wide(long, [1, 2, 3])


def test_percent_agreement(wide):
    r = A.percent_agreement(wide, "coder_1", "coder_2").first()
    assert (r.n_equal, r.n_total) == (273, 306)
    assert r.percent == pytest.approx(89.215686, abs=1e-6)


def test_cohen_kappa(wide):
    assert A.cohen_kappa(wide, "coder_1", "coder_2").first().kappa == pytest.approx(0.683229814, abs=1e-9)


def test_specific_agreement(long):
    two = {r.score: r.agreement for r in A.category_agreement(long.filter("rater in (1, 2)")).collect()}
    assert two[1] == pytest.approx(0.751879699, abs=1e-9)
    assert two[0] == pytest.approx(0.931106472, abs=1e-9)
    three = {r.score: r.agreement for r in A.category_agreement(long).collect()}
    assert three[1] == pytest.approx(0.756880734, abs=1e-9)
    assert three[0] == pytest.approx(0.924285714, abs=1e-9)


def test_fleiss_kappa(long):
    assert A.fleiss_kappa(long).first().kappa == pytest.approx(0.681166448, abs=1e-9)


def test_mean_pairwise(wide):
    r = A.mean_pairwise_agreement(wide, ["coder_1", "coder_2", "coder_3"]).first()
    assert r.rounded == pytest.approx(88.452582, abs=1e-6)
    assert r.exact == pytest.approx(88.453159, abs=1e-6)


def test_discrepancies(wide):
    assert A.discrepancies(wide, "coder_1", "coder_2", "coder_3").count() == 20


def test_coder_vs_expert(long):
    r = {x.rater: x for x in A.coder_vs_expert(long, expert=3).collect()}
    assert abs(r[None].accuracy - 0.880719) < 2e-6 and abs(r[None].f1 - 0.759023) < 2e-6 and r[None].n is None
    assert (r[1].tp, r[1].fn, r[1].fp, r[1].tn) == (56, 29, 7, 214)
    assert r[1].accuracy == pytest.approx(0.882353, abs=1e-6)
    assert r[1].f1 == pytest.approx(0.756757, abs=1e-6)
    assert r[1].recall == pytest.approx(0.658824, abs=1e-6)
    assert r[1].precision == pytest.approx(0.888889, abs=1e-6)
    assert (r[2].tp, r[2].fn, r[2].fp, r[2].tn) == (59, 26, 11, 210)
    assert r[2].recall == pytest.approx(0.694118, abs=1e-6)
    assert r[2].precision == pytest.approx(0.842857, abs=1e-6)
    assert r[2].f1 == pytest.approx(0.761290, abs=1e-6)


def test_majority_and_unanimous_counts(long):
    from textlab.operators import labels as L
    maj = L.majority_label(long, "object_id", "score", "label")
    assert maj.count() == 306
    eq = L.unanimous_label(long, "object_id", "score", "label")
    # 205 all-zero + 48 all-one rows are unanimous.
    assert eq.count() == 253
    assert eq.filter(F.col("label") == 1).count() == 48
