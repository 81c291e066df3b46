"""Benchmark: run every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS] and
print one JSON line. Each query is fully computed with the ``noop`` sink (all columns,
nothing collected to the driver); the time includes building every input the query is
the first to need (queries share upstream tables like one model build). An untimed
warm-up pass over the smallest test tables comes first (BENCH_WARMUP=0 disables it)."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from ledgerlight.session import build_session
    from ledgerlight.plans.registry import load_all

    spark = build_session(f"local[{cpus}]", app="ledgerlight-bench", shuffle_partitions=int(cpus) * 2)
    queries = load_all()
    names = only or list(queries)
    # JVM warm-up (JIT, codegen caches): one untimed pass over the smallest test tables.
    # It uses another data directory, so no table or result is shared with the timed run.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    warmed = os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm_dir) and \
        os.path.abspath(warm_dir) != os.path.abspath(sf_dir)
    if warmed:
        for name in names:
            queries[name].run(spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = queries[name].run(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus),
                      "warmup": os.path.basename(warm_dir) if warmed else None}))


if __name__ == "__main__":
    main()
