"""Command-line job runner: ``spark-submit inspecta/plans/jobs.py CMD ...`` or ``python -m inspecta.plans.jobs CMD ...``.

    python -m inspecta.plans.jobs bulk-load   --feed ROOT --table PATH [--as-of YYYY-MM-DD]
    python -m inspecta.plans.jobs weekly      --feed ROOT --table PATH --checkpoint PATH [--order last_test|feed_date] [--zips]
    python -m inspecta.plans.jobs counts      --table PATH --out PATH [--days 60]
    python -m inspecta.plans.jobs forecast    --counts PATH --out PATH [--horizon 30]
    python -m inspecta.plans.jobs view        --counts PATH --forecast PATH --name NAME
    python -m inspecta.plans.jobs train       --table PATH --model PATH
    python -m inspecta.plans.jobs score       --table PATH --model PATH --out PATH
    python -m inspecta.plans.jobs lookup      --table PATH --model PATH --registration REG

Each command is one Spark application over the named inputs; outputs are
parquet tables (versioned for the main table) or a saved ML pipeline.
"""

from __future__ import annotations

import argparse
import datetime as dt

from inspecta.session import get_session


def _date(s: str | None):
    return dt.date.fromisoformat(s) if s else None


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="inspecta")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bulk-load")
    b.add_argument("--feed", required=True)
    b.add_argument("--table", required=True)
    b.add_argument("--partitions", type=int)
    w = sub.add_parser("weekly")
    w.add_argument("--feed", required=True)
    w.add_argument("--table", required=True)
    w.add_argument("--checkpoint", required=True)
    w.add_argument("--order", choices=["last_test", "feed_date"], default="last_test")
    w.add_argument("--zips", action="store_true")
    c = sub.add_parser("counts")
    c.add_argument("--table", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--days", type=int, default=60)
    f = sub.add_parser("forecast")
    f.add_argument("--counts", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--horizon", type=int, default=30)
    t = sub.add_parser("train")
    t.add_argument("--table", required=True)
    t.add_argument("--model", required=True)
    v = sub.add_parser("view")
    for o in ("--counts", "--forecast", "--name"):
        v.add_argument(o, required=True)
    s = sub.add_parser("score")
    for o in ("--table", "--model", "--out"):
        s.add_argument(o, required=True)
    k = sub.add_parser("lookup")
    for o in ("--table", "--model", "--registration"):
        k.add_argument(o, required=True)
    for p in (b, w, c, f, t, v, s, k):
        p.add_argument("--as-of")
        p.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    as_of = _date(a.as_of)

    from inspecta.sources.sinks import read_daily_counts, read_latest, write_daily_counts, write_table
    if a.cmd == "bulk-load":
        from inspecta.plans.pipelines import bulk_load
        print("version", bulk_load(spark, a.feed, a.table, as_of, a.partitions))
    elif a.cmd == "weekly":
        from inspecta.plans.pipelines import weekly_delta_ingest
        for batch, action, rows in weekly_delta_ingest(spark, a.feed, a.table, a.checkpoint, as_of, a.order, a.zips):
            print("batch", batch, action, rows)
    elif a.cmd == "counts":
        from inspecta.operators.counts import daily_counts
        write_daily_counts(daily_counts(read_latest(spark, a.table), as_of, a.days), a.out)
    elif a.cmd == "forecast":
        from inspecta.operators.forecast import forecast_training
        from inspecta.plans.pipelines import predict
        train = forecast_training(read_daily_counts(spark, a.counts), as_of)
        write_table(predict(train, a.horizon), a.out, "overwrite")
    elif a.cmd == "view":
        from inspecta.plans.pipelines import create_chart_view
        create_chart_view(spark, a.name, a.counts, a.forecast, as_of)
    elif a.cmd == "train":
        from inspecta.operators.classify import fit_pass_fail, pass_fail_training, save_model
        save_model(fit_pass_fail(pass_fail_training(read_latest(spark, a.table))), a.model)
    elif a.cmd == "score":
        from inspecta.operators.classify import load_model, score
        write_table(score(load_model(a.model), read_latest(spark, a.table).drop("motTests")), a.out, "overwrite")
    elif a.cmd == "lookup":
        from inspecta.operators.classify import load_model, lookup_score
        keys = spark.createDataFrame([(a.registration,)], "registration string")
        lookup_score(load_model(a.model), read_latest(spark, a.table), keys).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
