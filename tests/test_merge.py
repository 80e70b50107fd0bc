import datetime as dt

import pytest
from pyspark.sql import functions as F

from inspecta.operators.enrich import enrich
from inspecta.operators.merge import (
    dedupe_delta, drop_deleted, merge_report, new_vehicles, prepare_delta, upsert, valid_delta,
)
from inspecta.schema import VEHICLE

AS_OF = dt.date(2024, 1, 31)


def _rows(spark, rows, extra=True):
    base = {f: None for f in VEHICLE.fieldNames()}
    data = [{**base, **r} for r in rows]
    df = spark.createDataFrame(data, VEHICLE)
    if extra:
        df = df.withColumn("date", F.lit("01-01-2024")).withColumn("feed_date", F.lit(dt.date(2024, 1, 1)))
    return df


def _main(spark):
    return enrich(_rows(spark, [
        {"registration": r, "make": "OLD", "lastMotTestDate": dt.datetime(2023, 1, 1)}
        for r in ("keep", "del", "upd", "cre")]), AS_OF)


def _delta(spark):
    t = dt.datetime
    return _rows(spark, [
        {"registration": "del", "modification": "DELETED", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": "upd", "modification": "UPDATED", "make": "NEW", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": "upd", "modification": "DELETED", "lastMotTestDate": t(2024, 1, 1)},  # older
        {"registration": "cre", "modification": "CREATED", "make": "NEW", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": "ins", "modification": "UPDATED", "make": "NEW", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": "gone", "modification": "DELETED", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": "noise", "modification": "NOISE", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": "nullmod", "modification": None, "lastMotTestDate": t(2024, 1, 2)},
        {"registration": None, "modification": "CREATED", "make": "NULLKEY", "lastMotTestDate": t(2024, 1, 2)},
    ], extra=False).withColumn("date", F.lit("09-09-2099")).withColumn("feed_date", F.lit(dt.date(2099, 9, 9)))


@pytest.mark.parametrize("strategy", ["broadcast", "bloom", "shuffle", "auto"])
def test_five_merge_cases(spark, strategy):
    main = _main(spark)
    prepared = prepare_delta(_delta(spark), AS_OF)
    out = {r.registration: r for r in upsert(main, prepared, strategy=strategy).collect()}
    assert set(out) == {"keep", "upd", "cre", "ins", None}
    assert out["keep"].make == "OLD"
    assert out["upd"].make == "NEW" and out["upd"].modification == "UPDATED"
    # columns the MERGE does not set keep main's value / are NULL on insert
    assert out["upd"].date == "01-01-2024" and out["upd"].feed_date == dt.date(2024, 1, 1)
    assert out["ins"].date is None and out["ins"].feed_date is None
    assert out[None].make == "NULLKEY"


def test_forms_agree_and_idempotent(spark):
    main = _main(spark)
    prepared = prepare_delta(_delta(spark), AS_OF)
    a = upsert(main, prepared, strategy="broadcast")
    b = upsert(main, prepared, strategy="shuffle")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    twice = upsert(a.where(F.col("registration").isNotNull()), prepared, strategy="broadcast")
    once = a
    # NULL keys never match, so they are inserted again on each run (kept aside here)
    assert twice.exceptAll(once).count() == 0 and once.exceptAll(twice).count() == 0


def test_row_count_identity(spark):
    main = _main(spark)
    prepared = prepare_delta(_delta(spark), AS_OF)
    rep = {r.action: r.rows for r in merge_report(main, prepared).collect()}
    out = upsert(main, prepared).count()
    assert out == main.count() - rep.get("delete", 0) + rep.get("insert", 0)
    assert rep == {"keep": 1, "delete": 1, "update": 2, "insert": 2, "ignore": 1}
    assert new_vehicles(main, prepared).count() == 2
    assert drop_deleted(main, prepared).count() == 3


def test_valid_and_dedupe(spark):
    d = valid_delta(_delta(spark))
    assert d.where(F.col("registration").isin("noise", "nullmod")).count() == 0
    dd = {r.registration: r.modification for r in dedupe_delta(d).collect()}
    assert dd["upd"] == "UPDATED"       # newest lastMotTestDate wins


def test_dedupe_ties_are_deterministic_and_prefer_deleted(spark):
    t = dt.datetime(2024, 1, 2)
    df = _rows(spark, [
        {"registration": "x", "modification": "UPDATED", "lastMotTestDate": t, "make": "A"},
        {"registration": "x", "modification": "DELETED", "lastMotTestDate": t, "make": "B"},
        {"registration": "y", "modification": "UPDATED", "lastMotTestDate": None, "make": "C"},
        {"registration": "y", "modification": "UPDATED", "lastMotTestDate": t, "make": "D"},
    ])
    got = {r.registration: r.make for r in dedupe_delta(df).collect()}
    assert got == {"x": "B", "y": "D"}   # NULL date sorts last under DESC


def test_duplicates_error(spark):
    delta = enrich(_delta(spark).where("registration = 'upd'"), AS_OF)
    with pytest.raises(ValueError):
        upsert(_main(spark), delta, duplicates="error")


def test_feed_date_order_lets_a_later_delete_win(spark):
    t = dt.datetime
    df = _rows(spark, [
        {"registration": "x", "modification": "UPDATED", "lastMotTestDate": t(2024, 1, 5), "make": "U"},
        {"registration": "x", "modification": "DELETED", "lastMotTestDate": t(2024, 1, 1), "make": "D"},
    ], extra=False).withColumn(
        "feed_date", F.when(F.col("make") == "D", F.lit(dt.date(2024, 2, 1))).otherwise(F.lit(dt.date(2024, 1, 6))))
    assert dedupe_delta(df).first().make == "U"                      # newest test date (reference order)
    assert dedupe_delta(df, order="feed_date").first().make == "D"   # newest feed first


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_unprepared_modifications_never_act(spark, strategy):
    main = _main(spark)
    raw = enrich(_rows(spark, [
        {"registration": "keep", "modification": None, "lastMotTestDate": dt.datetime(2024, 1, 2)},
        {"registration": "del", "modification": "NOISE", "lastMotTestDate": dt.datetime(2024, 1, 2)},
    ]), AS_OF)
    out = upsert(main, raw, strategy=strategy)
    assert sorted(r.registration for r in out.collect()) == ["cre", "del", "keep", "upd"]
    assert {r.action: r.rows for r in merge_report(main, raw).collect()} == {"keep": 4}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_duplicates_are_deduped(spark, strategy):
    t = dt.datetime
    delta = enrich(_rows(spark, [
        {"registration": "upd", "modification": "UPDATED", "make": "A", "lastMotTestDate": t(2024, 1, 1)},
        {"registration": "upd", "modification": "UPDATED", "make": "B", "lastMotTestDate": t(2024, 1, 3)},
        {"registration": "upd", "modification": "DELETED", "lastMotTestDate": t(2024, 1, 2)},
        {"registration": None, "modification": "UPDATED", "make": "N"},
        {"registration": None, "modification": "UPDATED", "make": "N"},
    ]), AS_OF)
    out = upsert(_main(spark), delta, strategy=strategy).collect()
    assert [r.make for r in out if r.registration == "upd"] == ["B"]
    assert sum(r.registration is None for r in out) == 2 and len(out) == 6


def test_missing_set_column_raises(spark):
    delta = enrich(_delta(spark), AS_OF).drop("make")
    with pytest.raises(ValueError, match="make"):
        upsert(_main(spark), delta)


def test_forced_broadcast_is_size_checked(spark):
    prepared = prepare_delta(_delta(spark), AS_OF)
    with pytest.raises(ValueError, match="broadcast bound"):
        upsert(_main(spark), prepared, strategy="broadcast", max_broadcast_keys=1)
    a = upsert(_main(spark), prepared, max_broadcast_keys=1).collect()      # auto goes to the shuffle form
    assert sorted(map(str, a)) == sorted(map(str, upsert(_main(spark), prepared).collect()))


def test_report_with_null_keys_on_both_sides(spark):
    main = _main(spark).unionByName(_main(spark).limit(3).withColumn("registration", F.lit(None).cast("string")))
    delta = prepare_delta(_delta(spark), AS_OF)
    for strategy in ("broadcast", "bloom", "shuffle"):
        got = {r.action: r.rows for r in merge_report(main, delta, strategy=strategy).collect()}
        assert got == {"keep": 4, "delete": 1, "update": 2, "insert": 2, "ignore": 1}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def _stored_main(spark, tmp_path, n=2000):
    path = str(tmp_path / "main")
    rows = spark.range(n).select(F.concat(F.lit("R"), F.col("id")).alias("registration"), F.lit("OLD").alias("make"),
                                 F.lit(None).cast("string").alias("modification"), F.col("id").alias("extra"))
    rows.unionByName(rows.limit(9).withColumn("registration", F.lit(None).cast("string"))).write.parquet(path)
    return spark.read.parquet(path)


def _small_delta(spark, n=300, nulls=50):
    base = spark.range(1900, 1900 + n).select(
        F.concat(F.lit("R"), F.col("id")).alias("registration"), F.lit("NEW").alias("make"),
        F.when(F.col("id") % 3 == 0, "DELETED").otherwise("UPDATED").alias("modification"))
    none = spark.range(nulls).select(F.lit(None).cast("string").alias("registration"), F.lit("NEW").alias("make"),
                                     F.lit("CREATED").alias("modification"))
    return base.unionByName(none)


@pytest.mark.parametrize("settings", [{}, {"bits_per_key": 0.001, "block_bits": 64}, {"bits_per_key": 3}])
def test_bloom_form_equals_shuffle_form(spark, tmp_path, monkeypatch, settings):
    monkeypatch.setattr("inspecta.operators.merge.MERGE_SET_COLUMNS", ["make", "modification"])
    main, delta = _stored_main(spark, tmp_path), _small_delta(spark)
    want = upsert(main, delta, strategy="shuffle", duplicates="trust")
    got = upsert(main, delta, strategy="bloom", duplicates="trust", **settings)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.count() == 2000 + 9 + 133 + 50 - 33        # 200 unmatched less their deletes, keyless, matched deletes


def test_bloom_filter_has_no_false_negatives(spark):
    from inspecta.operators.bloom import KeyFilter
    keys = spark.range(0, 5000, 2).withColumnRenamed("id", "k").unionByName(spark.sql("select cast(null as bigint) as k"))
    every = spark.range(10000).withColumnRenamed("id", "k").unionByName(spark.sql("select cast(null as bigint) as k"))
    for kw, most in (({}, 250), ({"bits_per_key": 1}, 7500), ({"block_bits": 512}, 1500), ({"max_bytes": 64, "block_bits": 512}, 7500)):
        got = KeyFilter(keys, "k", 2500, **kw).test(every, "k", "may")
        assert got.columns == ["k", "may"] and got.count() == 10001
        assert got.where("may is null or (k is null and may) or (k < 5000 and k % 2 = 0 and not may)").count() == 0
        assert got.where("may and (k >= 5000 or k % 2 = 1)").count() <= most
    assert KeyFilter(keys.where("false"), "k", 0).test(every, "k", "may").where("may").count() == 0


def test_bloom_form_shuffles_only_what_may_match(spark, tmp_path, monkeypatch):
    """Main's branch of untouched rows has a broadcast join and no exchange."""
    from inspecta.operators.merge import merged_rows
    main, delta = _stored_main(spark, tmp_path), _small_delta(spark).checkpoint()
    out = merged_rows(main, delta, "registration", ["make", "modification"], "bloom", 300)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # of the union's branches that scan main, one is joined by a shuffle and one isn't
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))      # noqa: E731
    lines, branches = plan.splitlines(), []
    union = next(i for i, x in enumerate(lines) if "Union" in x)
    below = min(depth(x) for x in lines[union + 1:] if x.strip())
    for x in lines[union + 1:]:
        if depth(x) == below:
            branches.append([])
        branches[-1].append(x)
    scans = [b for b in map("\n".join, branches) if "FileScan" in b]
    outer = [b for b in scans if "SortMergeJoin" in b]
    rest = [b for b in scans if "SortMergeJoin" not in b]
    assert len(outer) == 1 and len(rest) == 1
    stream_side = rest[0][:rest[0].index("BroadcastExchange")]
    assert "FileScan" in stream_side and "Exchange hashpartitioning" not in stream_side


@pytest.mark.parametrize("form", ["broadcast", "bloom", "shuffle"])
def test_null_keys_reach_no_join(spark, tmp_path, form):
    """Below every join, both sides are filtered to rows that have keys, or main is
    probed map-side; no shuffle partition collects the keyless records."""
    from inspecta.operators.merge import merged_rows
    delta = _small_delta(spark, 30, 1000).checkpoint()
    main = _stored_main(spark, tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merged_rows(main, delta, "registration", ["make", "modification"], form, 30).where("registration is null")
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) > 500 and max(sizes) < sum(sizes)      # still spread as they came in
        joins = merged_rows(main, delta, "registration", ["make", "modification"], form, 30)._jdf.queryExecution().optimizedPlan().toString()
        for side in joins.split("Join FullOuter")[1:] + joins.split("Join LeftOuter")[1:]:
            assert "isnotnull(registration" in side
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("strategy", ["broadcast", "bloom", "shuffle"])
def test_actions_are_observed_by_the_write(spark, tmp_path, strategy):
    from pyspark.sql import Observation
    seen = Observation()
    out = upsert(_main(spark), prepare_delta(_delta(spark), AS_OF), strategy=strategy, report=seen)
    out.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"keep": 1, "delete": 1, "update": 2, "insert": 2, "ignore": 1}
    assert "_action" not in out.columns


def test_broadcast_is_bounded_by_bytes(spark):
    from inspecta.operators.merge import choose_strategy, maybe_broadcast
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("registration"))
    assert choose_strategy(wide, "registration", "auto", 1000, 10_000)[0] == "bloom"
    assert choose_strategy(wide, "registration", "auto", 1000, 100_000) == ("broadcast", 100)
    with pytest.raises(ValueError, match="bytes"):
        choose_strategy(wide, "registration", "broadcast", 1000, 10_000)
    assert "broadcast" not in maybe_broadcast(wide, 1000, 10_000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in maybe_broadcast(wide, 1000, 100_000)._jdf.queryExecution().logical().toString().lower()
