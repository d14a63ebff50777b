"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built from the raw tables and run to completion into Spark's ``noop``
sink (every row produced, nothing collected).  $BENCH_WARMUP (2) untimed passes over
all queries warm the JVM (JIT, code generation), then $BENCH_RUNS (3) timed passes
run the queries interleaved; the reported time per query is its median (steady
state).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = ["dedup_latest", "silver_merge", "gold_daily", "gold_hourly", "gold_product", "dq_results", "bronze_ingest"]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARMUP = int(os.environ.get("BENCH_WARMUP", "2"))


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)),
        extra={"spark.tidemark.feed.spread": str(cpus), "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    names = sys.argv[1:] or HEADLINE
    errors: dict[str, str] = {}

    def attempt(name: str) -> float | None:
        if name in errors:
            return None
        try:
            return run_once(spark, name, sf_dir)
        except Exception as ex:  # noqa: BLE001 - report the failure, keep timing the others
            errors[name] = f"{type(ex).__name__}: {str(ex)[:300]}"
            return None

    for _ in range(WARMUP):                        # untimed
        for name in names:
            attempt(name)
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(RUNS):
        for name in names:
            t = attempt(name)
            if t is not None:
                runs[name].append(t)
    times = {name: round(statistics.median(r), 3) for name, r in runs.items() if r and name not in errors}
    if os.environ.get("BENCH_VERBOSE"):
        print(json.dumps({n: [round(x, 2) for x in r] for n, r in runs.items()}), file=sys.stderr)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
           "cpus": cpus, "runs": RUNS, "warmup": WARMUP}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
