"""Physical-plan audit of every registered query.

Usage: python -m tools.plan_audit [sf_dir] [out_dir]

Writes each query's formatted plan to ``out_dir`` and reports the operators
that matter at scale: cartesian / nested-loop joins (must not appear),
exchanges, broadcasts, Python evaluation (pandas UDFs, mapInPandas).
Builders that run jobs while planning (fits, checkpoints) are executed.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

WATCH = ["CartesianProduct", "BroadcastNestedLoopJoin", "Exchange", "BroadcastExchange",
         "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "BatchEvalPython"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="plans-")
    from textlab.plans.registry import all_queries
    from textlab.session import checkpoint_dir, local_session
    spark = local_session()
    checkpoint_dir(spark)
    bad = []
    for name, q in all_queries().items():
        df = q.build(spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        with open(os.path.join(out, f"{name}.txt"), "w") as fh:
            fh.write(plan)
        counts = {w: len(re.findall(rf"\b{w}\b \(", plan)) for w in WATCH}
        flag = counts["CartesianProduct"] + counts["BroadcastNestedLoopJoin"]
        if flag:
            bad.append(name)
        print(f"{name:32s} " + " ".join(f"{k}={v}" for k, v in counts.items() if v))
    print(f"plans in {out}; cross/nested-loop joins in: {bad or 'none'}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
