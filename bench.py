"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The inputs derived from the tables are written once and timed apart.  Each
query runs once to warm up, then three times; the median wall time of
a full execution (``noop`` sink: every row computed, nothing collected) is
reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["enrich", "enrich_flat", "dedupe_delta", "upsert", "upsert_shuffle", "merge_report",
            "daily_counts", "forecast_training", "fill_daily", "clean_spikes", "prediction_output",
            "feed_round_trip", "fit_forecast", "score", "budget_overruns",
            "weekly_delta_ingest", "analytics_chain", "upsert_bloom", "changelog_read",
            "counts_incremental", "seasonal_forecast"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from inspecta.plans.registry import QUERIES
    from inspecta.session import get_session

    # one shuffle partition per core at these sizes; AQE coalesces further
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=parts,
                        extra={"spark.driver.memory": "16g"})
    from inspecta import fixtures
    t0 = time.perf_counter()
    fixtures.materialise(spark, sf_dir)     # inputs once, outside the queries' times
    inputs_sec = round(time.perf_counter() - t0, 3)
    times, errors = {}, {}
    for name in (only or HEADLINE):
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up (JIT, file listing cache)
            times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - report, keep timing the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir).removeprefix("sf")
    out = {"metric": "headline_total_median", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
           "inputs_sec": inputs_sec}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
