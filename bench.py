"""Benchmark of the headline queries.

Runs each headline query of the registry at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is fully computed into Spark's ``noop`` sink (no collect to the
driver); the time is the wall time of that write.  The first run warms
the JVM (code generation, class loading); the reported time is the best run.
``history_build`` is the time to build the stored histories, once each.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [x for x in os.environ.get("BENCH_QUERIES", "").split(",") if x]
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    from spanlog.session import build_session
    scratch = tempfile.mkdtemp(prefix="spanlog-bench-")
    spark = build_session(master=f"local[{cpus}]", app="spanlog-bench",
                          shuffle_partitions=max(8, 2 * int(cpus)),
                          extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    from spanlog.plans.catalog import HEADLINE, QUERIES
    names = only or list(HEADLINE)
    # the histories that queries read are stored tables: building them is timed apart from the queries
    from spanlog.plans import fixtures
    build: dict[str, float] = {}
    for view in ("hist_events", "hist_orders"):
        t0 = time.perf_counter()
        getattr(fixtures, view)(spark, sf_dir)
        build[view] = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)  # best of the runs (the first one warms up)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "history_build": build, "sf": sf, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
