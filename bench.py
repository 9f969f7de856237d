"""Benchmark: wall seconds per registered query.

Runs every query of the registry (or the comma-separated
``BENCH_QUERIES``) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line.  Each query is executed in
full through the ``noop`` sink (every row produced, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tessera.plans.registry import load_all  # noqa: E402
from tessera.plans.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    reg = load_all()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, q in reg.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "n_queries": len(times),
           "shuffle_partitions": cpus * 2}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
