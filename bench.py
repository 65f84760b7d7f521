"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed through the ``noop`` sink (no collect to the
driver).  Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mine_rules", "rule_baseline", "rule_predict", "tfidf", "vocabulary",
    "stratified_splits", "threshold_sweep", "attach_label_variants", "fleiss_kappa",
    "coder_vs_expert", "html_to_text", "html_to_md", "text_variants", "section_patterns",
    "data_valuation", "label_issues", "smote", "variant_comparison", "pack_blocks", "trial_ranking",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from textlab.plans.registry import all_queries
    from textlab.session import checkpoint_dir, local_session
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2))
    checkpoint_dir(spark)
    qs = all_queries()
    names = [n for n in HEADLINE if n in qs]
    times = {}
    # Warm-up: JVM start-up, JIT and Python workers are not query time.  The
    # flagship runs once on the tiny sf0.001 tables (other data) first.
    spark.range(1000).selectExpr("sum(id)").collect()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small) and "mine_rules" in qs:
        qs["mine_rules"].build(spark, small).write.format("noop").mode("overwrite").save()
    for n in names:
        t0 = time.time()
        qs[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
