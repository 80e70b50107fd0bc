"""Write PLANS.md: physical plans of the core operators on stored inputs.

    python scripts/explain_plans.py [sf_dir]

Inputs are first written as parquet (as a deployment would store them), so
the plans show scans, pushed filters, read schemas and exchanges of the
operators themselves rather than of the fixture builders.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from inspecta import fixtures as fx  # noqa: E402
from inspecta.operators.counts import daily_counts  # noqa: E402
from inspecta.operators.enrich import enrich, enrich_flat  # noqa: E402
from inspecta.operators.forecast import fill_daily, fit_forecast, forecast_training  # noqa: E402
from inspecta.operators.merge import dedupe_delta, prepare_delta, upsert, valid_delta  # noqa: E402
from inspecta.session import get_session, scratch_dir  # noqa: E402
from inspecta.sources.sinks import write_bucketed  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    keep = []
    for line in text.splitlines():
        if line.startswith(("(", "Output", "Input", "Arguments: isFinal")) and "ReadSchema" not in line:
            continue
        keep.append(line)
    return "\n".join(x for x in keep if x.strip())


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    base = scratch_dir(spark, "plans")
    fx.history(spark, sf).write.parquet(f"{base}/history")
    fx.main_table(spark, sf).write.parquet(f"{base}/main")
    fx.delta(spark, sf).write.parquet(f"{base}/delta")
    fx.series_counts(spark, sf).write.parquet(f"{base}/counts")
    history = spark.read.parquet(f"{base}/history")
    main = spark.read.parquet(f"{base}/main")
    delta = spark.read.parquet(f"{base}/delta")
    counts = spark.read.parquet(f"{base}/counts")
    enriched = enrich(history, fx.AS_OF_HISTORY)
    enriched.write.parquet(f"{base}/enriched")
    write_bucketed(main, "plans_main_b", f"{base}/main_b", 16)
    prepared = prepare_delta(delta, fx.AS_OF_DELTA)
    cases = [
        ("enrich: one projection, no exchange", enriched),
        ("enrich_flat: partial aggregation before the shuffle",
         enrich_flat(history.drop("motTests"),
                     history.select("registration", F.inline("motTests")), fx.AS_OF_HISTORY)),
        ("dedupe_delta: partial WindowGroupLimit before the exchange", dedupe_delta(valid_delta(delta))),
        ("upsert (broadcast keys): main scanned twice, never shuffled",
         upsert(main, prepared, strategy="broadcast")),
        ("upsert (Bloom filter of keys): main's rows that can't match pass without an exchange",
         upsert(main, prepared, strategy="bloom")),
        ("upsert (bucketed main): only the delta is hash-partitioned",
         upsert(spark.table("plans_main_b"), prepared, buckets=16)),
        ("daily_counts on the stored enriched table: pushed filter, narrow read schema, partial count",
         daily_counts(spark.read.parquet(f"{base}/enriched"), fx.AS_OF_HISTORY)),
        ("daily_counts straight from nested records: nested-column pruning to two test fields",
         daily_counts(enrich(history, fx.AS_OF_HISTORY), fx.AS_OF_HISTORY)),
        ("forecast_training: scalar subquery",
         forecast_training(counts, fx.AS_OF_HISTORY)),
        ("fit_forecast: closed-form models by aggregates per series",
         fit_forecast(fill_daily(forecast_training(counts, fx.AS_OF_HISTORY)).drop("filled"))),
    ]
    out = ["# Physical plans of the core operators",
           "",
           f"Generated by `scripts/explain_plans.py` on `{sf}` (inputs stored as parquet first), "
           "`local[8]`, AQE on. Plans before AQE re-optimisation (`isFinalPlan=false`).", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
