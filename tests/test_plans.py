"""Physical-plan checks: the shapes the scale design relies on."""

import contextlib
import datetime as dt
import io
import re


from inspecta import fixtures as fx
from inspecta.operators.counts import daily_counts
from inspecta.operators.enrich import enrich, enrich_flat
from inspecta.operators.merge import dedupe_delta, prepare_delta, upsert, valid_delta
from tests.conftest import SF_SMOKE


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_enrich_is_one_projection_without_shuffle(spark, tmp_path):
    fx.history(spark, SF_SMOKE).write.parquet(str(tmp_path / "h"))
    h = spark.read.parquet(str(tmp_path / "h"))
    p = plan(enrich(h, dt.date(2001, 8, 1)))
    assert "Exchange" not in p
    assert enrich(h, dt.date(2001, 8, 1)).count() == h.count()


def test_broadcast_upsert_does_not_shuffle_main(spark, tmp_path):
    fx.main_table(spark, SF_SMOKE).write.parquet(str(tmp_path / "main"))
    main = spark.read.parquet(str(tmp_path / "main"))
    prepared = prepare_delta(fx.delta(spark, SF_SMOKE), fx.AS_OF_DELTA)
    p = plan(upsert(main, prepared, strategy="broadcast"))
    # every Exchange in the plan is a broadcast; main's scans feed hash joins directly
    exchanges = re.findall(r"\b(\w*Exchange)\b", p.split("\n\n")[0])
    assert exchanges and set(exchanges) == {"BroadcastExchange"}
    assert "LeftAnti" in p and "LeftSemi" in p
    # the matched slice of main is read with only the key and unset columns
    assert re.search(r"ReadSchema: struct<registration:string,date:string,feed_date:date>", p)


def test_dedupe_limits_before_shuffle(spark):
    p = plan(dedupe_delta(valid_delta(fx.delta(spark, SF_SMOKE))))
    assert re.search(r"WindowGroupLimit.*Partial", p, re.S)
    top = p.split("\n\n")[0]
    assert top.index("Exchange") < top.rindex("WindowGroupLimit")   # partial limit below the exchange


def test_counts_aggregate_partially_and_push_filters(spark, tmp_path):
    fx.history(spark, SF_SMOKE).transform(lambda h: enrich(h, fx.AS_OF_HISTORY)).drop("motTests") \
        .write.parquet(str(tmp_path / "e"))
    e = spark.read.parquet(str(tmp_path / "e"))
    p = plan(daily_counts(e, fx.AS_OF_HISTORY))
    assert "partial_count" in p
    assert re.search(r"PushedFilters: \[.*last_test_date.*\]", p)
    assert re.search(r"ReadSchema: struct<last_test_date:timestamp_ntz,last_test_result:string>", p)


def test_enrich_flat_combines_map_side(spark):
    h = fx.history(spark, SF_SMOKE)
    p = plan(enrich_flat(h.drop("motTests"), fx.tests_flat(spark, SF_SMOKE), fx.AS_OF_HISTORY))
    # count_if is rewritten to a partial count; max_by runs as a partial sort aggregate
    assert "partial_max_by" in p and "partial_count" in p


def test_bucketed_upsert_shuffles_only_the_delta(spark, tmp_path):
    from inspecta.sources.sinks import write_bucketed
    write_bucketed(fx.main_table(spark, SF_SMOKE), "plan_main_b", str(tmp_path / "mb"), 4)
    prepared = prepare_delta(fx.delta(spark, SF_SMOKE), fx.AS_OF_DELTA)
    out = upsert(spark.table("plan_main_b"), prepared, buckets=4)
    p = plan(out, "simple")
    assert "FullOuter" in p
    # the only hash exchange is the delta's repartition into the buckets
    assert p.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in p
