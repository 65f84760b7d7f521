"""The agreement interval draws a weight for every object."""

import collections
import hashlib

import numpy as np
from pyspark.sql import functions as F

from textlab.operators import agreement as A


def test_every_object_has_its_own_weight(spark):
    ratings = [(r, i, int((i * 7 + r) % 5 < 2)) for i in range(60) for r in (1, 2, 3)] + [(1, 99, 1), (1, 98, None), (2, 98, 0)]
    long = spark.createDataFrame(ratings, "rater int, object_id long, score int")
    assert A.object_weights(long, 20).count() == 60 * 20
    counts = collections.defaultdict(collections.Counter)
    for _, i, s in ratings:
        if s is not None:
            counts[i][s] += 1
    agreement = collections.defaultdict(list)
    for b in range(1, 21):
        num, den = collections.Counter(), collections.Counter()
        for i, c in counts.items():
            n = sum(c.values())
            if n < 2:
                continue
            u = int(hashlib.md5(f"42:{b}:{i}".encode()).hexdigest()[:15], 16) / float(1 << 60)
            w = next((k for k, p in enumerate(A.POISSON1_CDF) if u < p), len(A.POISSON1_CDF))
            for s, k in c.items():
                num[s] += w * k * (k - 1)
                den[s] += w * k * (n - 1)
        for s in den:
            if den[s]:
                agreement[s].append(num[s] / den[s])
    got = {r["score"]: r for r in A.category_agreement_ci(long, replicates=20).collect()}
    assert set(got) == set(agreement)
    for s, a in agreement.items():
        assert got[s]["replicates"] == len(a)
        assert abs(got[s]["ci_low"] - np.quantile(a, 0.025)) < 2e-6 and abs(got[s]["ci_high"] - np.quantile(a, 0.975)) < 2e-6
    assert not A.category_agreement_ci(long.where(F.lit(False)), replicates=5).count()
