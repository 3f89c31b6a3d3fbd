"""Summarise the physical plans of registered queries (operators that matter at scale).

usage: python tools/plan_report.py [sf_dir] [name ...]   (default: the headline queries)
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window ", "WindowGroupLimit", "Generate",
         "MapInPandas", "BatchEvalPython", "ArrowEvalPython", "Scan parquet", "WholeStageCodegen"]


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from spanlog.session import build_session
    spark = build_session(shuffle_partitions=16, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="plans-")})
    spark.sparkContext.setLogLevel("OFF")
    from spanlog.plans.catalog import HEADLINE, QUERIES
    names = argv[2:] or HEADLINE
    for name in names:
        df = QUERIES[name](spark, sf)
        p = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        counts = {k.strip(): len(re.findall(re.escape(k), p)) for k in KINDS}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", p)))
        shown = ", ".join(f"{k}={v}" for k, v in counts.items() if v)
        print(f"## {name}\n{shown}")
        for x in pushed:
            if x:
                print(f"  pushed: {x[:160]}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
