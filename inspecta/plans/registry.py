"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta import fixtures as fx
from inspecta.operators import changelog
from inspecta.operators.counts import all_counts, apply_changes, count_changes, daily_counts
from inspecta.operators.enrich import enrich, enrich_flat
from inspecta.operators.merge import (
    dedupe_delta, drop_deleted, merge_report, new_vehicles, prepare_delta, upsert, valid_delta,
)
from inspecta.operators.forecast import (
    ar1_baseline, ar1_forecast, clean_seasonal_spikes, clean_spikes, complete_dates, evaluate_forecast, fill_daily,
    fit_forecast, forecast, forecast_training, holiday_effect, prediction_output, training_cutoff,
    with_holidays,
)
from inspecta.operators.classify import (
    FEATURES, class_weights, fit_pass_fail, load_model, lookup, lookup_score, model_weights, pass_fail_training,
    save_model, score, score_by_weights, what_if, what_if_score,
)
from inspecta.operators.seasonal import effects, search_orders, seasonal_forecast
from inspecta.functions.columns import pass_probability
from inspecta.plans.pipelines import (
    analytics, bulk_load, create_chart_view, load_feed, register_views, weekly_delta_ingest,
)
from inspecta.schema import VEHICLE
from inspecta.session import hadoop_path, scratch_dir
from inspecta.streaming.streams import budget_overruns, ingest, start_log, start_upsert, stream_feed
from inspecta.sources.feed import (
    counted, feed_folders, feed_glob, feed_schema, feed_stats, folder_schemas, latest_feed, load_counts, normalise_feed,
    read_feed, read_feed_zip, read_latest_feed, schema_drift, split_corrupt, write_feed, write_feed_zip,
)
from inspecta.sources.zips import read_zips, stream_zips
from inspecta.sources.sinks import (
    create_main, drop_stage, read_latest, stage, write_bucketed, write_csv, write_daily_counts, write_table,
    write_version,
)

ENRICH_COLS = ["registration", "make", "model", "primaryColour", "fuelType", "engineSize",
               "firstUsedDate", "lastMotTestDate", "last_test_date", "last_test_result",
               "mileage", "vehicle_age", "pass_count", "fail_count", "n_tests"]

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _enriched_history(spark: SparkSession, d: str) -> DataFrame:
    return enrich(fx.history(spark, d), fx.AS_OF_HISTORY)


def _with_n_tests(df: DataFrame) -> DataFrame:
    return df.withColumn("n_tests", F.coalesce(F.size("motTests"), F.lit(0)).cast("bigint"))


# ---- enrich (P1-P7) --------------------------------------------------------
@query
def q_enrich(spark, d):
    return _with_n_tests(_enriched_history(spark, d)).select(*ENRICH_COLS)


@query
def q_enrich_flat(spark, d):
    h = fx.history(spark, d)
    # vehicle attributes + first-use date; the tests come from the flat log
    vehicles = h.select(*[c for c in h.columns if c != "motTests"], 
                        F.coalesce(F.size("motTests"), F.lit(0)).cast("bigint").alias("n_tests"))
    return enrich_flat(vehicles, fx.tests_flat(spark, d), fx.AS_OF_HISTORY).select(*ENRICH_COLS)


@query
def q_last_test(spark, d):
    return _enriched_history(spark, d).select("registration", "last_test_date", "last_test_result")


@query
def q_mileage(spark, d):
    return _enriched_history(spark, d).select("registration", "mileage")


@query
def q_vehicle_age(spark, d):
    return _enriched_history(spark, d).select("registration", "vehicle_age")


@query
def q_result_counts(spark, d):
    return _enriched_history(spark, d).select("registration", "pass_count", "fail_count")


# ---- counts (A1, A2, P11) --------------------------------------------------
@query
def q_daily_counts(spark, d):
    return daily_counts(_enriched_history(spark, d), fx.AS_OF_HISTORY)


@query
def q_daily_counts_by_day(spark, d):
    return daily_counts(_enriched_history(spark, d), fx.AS_OF_HISTORY, grain="day")


# ---- delta + merge (P9, W1, L1, J1-J4, SNK4, U2) ---------------------------
UPSERT_COLS = ["registration", "modification", "make", "model", "primaryColour", "secondaryColour",
               "fuelType", "engineSize", "manufactureDate", "registrationDate", "firstUsedDate",
               "lastMotTestDate", "last_test_date", "last_test_result", "mileage", "vehicle_age",
               "pass_count", "fail_count", "n_tests", "date", "feed_date"]


def _merge_inputs(spark, d):
    main = fx.main_table(spark, d, fx.AS_OF_DELTA)
    prepared = prepare_delta(fx.delta(spark, d), fx.AS_OF_DELTA)
    return main, prepared


@query
def q_valid_delta(spark, d):
    return valid_delta(fx.delta(spark, d)).select("registration", "modification", "lastMotTestDate", "event_id")


@query
def q_dedupe_delta(spark, d):
    return (dedupe_delta(valid_delta(fx.delta(spark, d)))
            .select("registration", "modification", "lastMotTestDate", "event_id"))


def _upsert(spark, d, strategy):
    main, prepared = _merge_inputs(spark, d)
    return _with_n_tests(upsert(main, prepared, strategy=strategy)).select(*UPSERT_COLS)


@query
def q_upsert(spark, d):
    return _upsert(spark, d, "auto")


@query
def q_upsert_broadcast(spark, d):
    return _upsert(spark, d, "broadcast")


@query
def q_upsert_bloom(spark, d):
    """Only main rows that pass a Bloom filter of the delta's keys are joined by a shuffle."""
    return _upsert(spark, d, "bloom")


@query
def q_upsert_bloom_crowded(spark, d):
    """The same with a filter of 64 bits, which most rows pass: false positives change nothing."""
    main, prepared = _merge_inputs(spark, d)
    out = upsert(main, prepared, strategy="bloom", bits_per_key=0.001, block_bits=64)
    return _with_n_tests(out).select(*UPSERT_COLS)


@query
def q_upsert_shuffle(spark, d):
    return _upsert(spark, d, "shuffle")


def _odd_delta(spark, d):
    """Every record of the delta, not deduped; those of one event type lose their key."""
    e = valid_delta(fx.delta(spark, d))
    return enrich(e.withColumn("registration", F.when(F.col("model") != "error", F.col("registration"))), fx.AS_OF_DELTA)


@query
def q_upsert_odd_keys(spark, d):
    """Repeated keys are deduped by the merge, records without a key are all inserted."""
    main = fx.main_table(spark, d, fx.AS_OF_DELTA)
    return _with_n_tests(upsert(main, _odd_delta(spark, d).drop("event_id"), strategy="shuffle")).select(*UPSERT_COLS)


@query
def q_upsert_odd_keys_broadcast(spark, d):
    """The same with the keys broadcast; records without a key reach no join."""
    main = fx.main_table(spark, d, fx.AS_OF_DELTA)
    return _with_n_tests(upsert(main, _odd_delta(spark, d).drop("event_id"), strategy="broadcast")).select(*UPSERT_COLS)


@query
def q_merge_observed(spark, d):
    """Rows per merge action, observed while the new version of main is written."""
    main, prepared = _merge_inputs(spark, d)
    counts = Observation()
    write_version(upsert(main, prepared, report=counts), scratch_dir(spark, "observed-main"))
    return spark.createDataFrame([(a, n) for a, n in counts.get.items() if n], "action string, rows bigint")


@query
def q_merge_report_null_keys(spark, d):
    """Merge actions when both sides have NULL keys (joined by a shuffle)."""
    main = fx.main_table(spark, d, fx.AS_OF_DELTA)
    main = main.withColumn("registration", F.when(F.col("fuelType") != "DIESEL", F.col("registration")))
    odd = _odd_delta(spark, d)
    delta = dedupe_delta(odd.where("registration is not null")).unionByName(odd.where("registration is null"))
    return merge_report(main, delta, strategy="shuffle")


@query
def q_merge_report(spark, d):
    main, prepared = _merge_inputs(spark, d)
    return merge_report(main, prepared)


@query
def q_new_vehicles(spark, d):
    main, prepared = _merge_inputs(spark, d)
    return new_vehicles(main, prepared).select(
        "registration", "modification", "lastMotTestDate", "last_test_result", "mileage")


@query
def q_drop_deleted(spark, d):
    main, prepared = _merge_inputs(spark, d)
    return drop_deleted(main, prepared).select("registration", "last_test_result", "mileage")


@query
def q_stage_union(spark, d):
    ev = fx.delta(spark, d)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = ev.where(F.col("lastMotTestDate") < cut)
    # later batch arrives without engineSize: the union fills it with NULL
    later = ev.where(F.col("lastMotTestDate") >= cut).drop("engineSize")
    return stage([first, later]).select("registration", "modification", "lastMotTestDate",
                                        "event_id", "engineSize")


# ---- series: training, grid, cleaning, holidays, baseline, blend (FC1-FC5, U1) ----
def _f3(spark, d):
    return fx.series_counts(spark, d)


def _f3_daily(spark, d):
    return _f3(spark, d).select(F.to_date("test_date").alias("test_date"), "result_type", "count")


def _training(spark, d):
    return forecast_training(_f3(spark, d), fx.AS_OF_HISTORY)


@query
def q_complete_dates(spark, d):
    return complete_dates(_f3(spark, d))


@query
def q_training_cutoff(spark, d):
    return training_cutoff(_f3(spark, d))


@query
def q_forecast_training(spark, d):
    return _training(spark, d)


@query
def q_fill_daily(spark, d):
    return fill_daily(_f3_daily(spark, d)).withColumn("count", F.round("count", 6))


@query
def q_clean_spikes(spark, d):
    return clean_spikes(fill_daily(_f3_daily(spark, d)).drop("filled")).withColumn("count", F.round("count", 6))


@query
def q_clean_seasonal_spikes(spark, d):
    """Spikes against the usual value of the weekday; weekly patterns stay."""
    return clean_seasonal_spikes(fill_daily(_f3_daily(spark, d)).drop("filled")).withColumn("count", F.round("count", 6))


def _holidays(spark, d):
    return with_holidays(fill_daily(_f3_daily(spark, d)).drop("filled"))


@query
def q_with_holidays(spark, d):
    return _holidays(spark, d).withColumn("count", F.round("count", 6))


@query
def q_holiday_effect(spark, d):
    return holiday_effect(_holidays(spark, d)).withColumn("effect", F.round("effect", 6))


@query
def q_ar1_baseline(spark, d):
    p = ar1_baseline(fill_daily(_training(spark, d)))
    return p.withColumn("phi", F.round("phi", 6)).withColumn("c", F.round("c", 6))


def _ar1_forecast(spark, d, horizon=30):
    return ar1_forecast(ar1_baseline(fill_daily(_training(spark, d))), horizon)


@query
def q_prediction_output(spark, d):
    out = prediction_output(_f3(spark, d), _ar1_forecast(spark, d), fx.AS_OF_HISTORY)
    return out.withColumn("count", F.round("count", 4))


def _fits(spark, d):
    counts = fx.series_counts(spark, d, with_abandoned=True)
    train = forecast_training(counts, fx.AS_OF_HISTORY, n_types=3)
    return fit_forecast(clean_spikes(fill_daily(train).drop("filled")))


def _rounded(df, digits=4):
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType == T.DoubleType() else f.name for f in df.schema])


@query
def q_fit_forecast(spark, d):
    return _rounded(_fits(spark, d).drop("weekdays", "chosen"))


@query
def q_forecast(spark, d):
    return _rounded(forecast(_fits(spark, d)))


@query
def q_evaluate_forecast(spark, d):
    return _rounded(evaluate_forecast(_fits(spark, d)))


@query
def q_forecast_blend(spark, d):
    """Blend of actual counts with the chosen model's forecast."""
    return _rounded(prediction_output(_f3(spark, d), forecast(_fits(spark, d)), fx.AS_OF_HISTORY))


# ---- calendar regression, order search and forecast (FC4-FC6) --------------------
def _clean_series(spark, d):
    counts = fx.series_counts(spark, d, with_abandoned=True)
    return clean_seasonal_spikes(fill_daily(forecast_training(counts, fx.AS_OF_HISTORY, n_types=3)).drop("filled"))


def _young_series(spark, d):
    """The first 1 to 14 days of each series, as series of their own."""
    x = _clean_series(spark, d)
    x = x.withColumn("lo", F.min("test_date").over(Window.partitionBy("result_type")))
    return (x.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(14)))).where(F.datediff("test_date", "lo") < F.col("k"))
            .select(F.concat_ws(" ", "result_type", "k").alias("result_type"), "test_date", "count"))


CANDIDATE_COLS = ["result_type", "d", "regressors", "p", "n", "rank", "sigma2", "log_likelihood", "aicc", "kpss", "chosen"]


@query
def q_order_search(spark, d):
    """Every differencing, regressor set and order with its corrected AIC."""
    return _rounded(search_orders(_clean_series(spark, d)).select(*CANDIDATE_COLS))


@query
def q_calendar_effects(spark, d):
    """Weekday and holiday effects of the chosen models."""
    return _rounded(effects(search_orders(_clean_series(spark, d))))


@query
def q_seasonal_forecast(spark, d):
    return _rounded(seasonal_forecast(search_orders(_clean_series(spark, d))))


@query
def q_young_order_search(spark, d):
    """Candidates for series of 1 to 14 days."""
    return _rounded(search_orders(_young_series(spark, d)).select(*[c for c in CANDIDATE_COLS if c not in ("rank", "log_likelihood", "kpss")]))


@query
def q_young_seasonal_forecast(spark, d):
    return _rounded(seasonal_forecast(search_orders(_young_series(spark, d))))


@query
def q_young_fit_forecast(spark, d):
    """The closed-form models on series of 1 to 14 days."""
    return _rounded(fit_forecast(_young_series(spark, d)).select("result_type", "model", "n", "sigma2", "aicc", "chosen"))


@query
def q_young_forecast(spark, d):
    return _rounded(forecast(fit_forecast(_young_series(spark, d))))


# ---- feed I/O (SRC1-SRC10) ------------------------------------------------------
FEED_COLS = ["registration", "modification", "lastMotTestDate", "firstUsedDate", "make",
             "engineSize", "feed_date", "date", "n_tests"]


@query
def q_feed_round_trip(spark, d):
    root = fx.write_feed_fixture(spark, d)
    return _with_n_tests(read_feed(spark, root)).select(*FEED_COLS)


@query
def q_feed_stats(spark, d):
    root = fx.write_feed_fixture(spark, d)
    return feed_stats(read_feed(spark, root))


@query
def q_latest_feed(spark, d):
    root = fx.write_feed_fixture(spark, d)
    return _with_n_tests(latest_feed(read_feed(spark, root, kind="delta"))).select(*FEED_COLS)


@query
def q_feed_corrupt_split(spark, d):
    root = fx.write_corrupt_feed_fixture(spark, d)
    good, _bad = split_corrupt(read_feed(spark, root, ext="*.gz"))
    return good.select("registration", "modification", "lastMotTestDate", "feed_date")


@query
def q_feed_corrupt_rows(spark, d):
    root = fx.write_corrupt_feed_fixture(spark, d)
    _good, bad = split_corrupt(read_feed(spark, root, ext="*.gz"))
    return bad.select("registration", F.length("raw").cast("bigint").alias("raw_length"))


@query
def q_feed_load_counts(spark, d):
    """Records per folder, counted by the load that writes them to a staging table."""
    root = fx.write_feed_fixture(spark, d)
    got = load_feed(spark, root, scratch_dir(spark, "staged"))
    return spark.createDataFrame([(f, n) for f, n in got.items() if f != "malformed"], "folder string, records bigint")


@query
def q_feed_load_malformed(spark, d):
    """Good records and malformed lines of the feed with truncated lines, counted by its load."""
    root = fx.write_corrupt_feed_fixture(spark, d)
    folders, seen = feed_folders(spark, root), Observation()
    good, _bad = split_corrupt(counted(read_feed(spark, root, ext="*.gz"), folders, seen))
    write_table(good, scratch_dir(spark, "staged"), "append")
    return spark.createDataFrame(list(load_counts(folders, seen).items()), "folder string, records bigint")


@query
def q_feed_schema(spark, d):
    """Fields and types of each feed folder and of the whole feed, from one pass."""
    return schema_drift(spark, folder_schemas(spark, fx.write_feed_fixture(spark, d)))


@query
def q_feed_read_by_schema(spark, d):
    """The feed read with the schema that the aggregate found."""
    root = fx.write_feed_fixture(spark, d)
    schema = feed_schema(folder_schemas(spark, root))
    return read_feed(spark, root, schema=schema).select("registration", "modification", "lastMotTestDate", "feed_date")


@query
def q_drop_stage(spark, d):
    """A staging table of the delta is loaded, counted and dropped."""
    name = "stage_" + scratch_dir(spark, "stage").rsplit("-", 1)[-1]
    fx.delta(spark, d).select("registration", "modification").write.option("path", scratch_dir(spark, "stage-table")).saveAsTable(name)
    staged = spark.table(name).count()
    drop_stage(spark, name)
    drop_stage(spark, name)       # nothing left to drop
    return spark.createDataFrame([(staged, spark.catalog.tableExists(name))], "staged bigint, still_there boolean")


@query
def q_feed_zip(spark, d):
    root = fx.write_feed_fixture(spark, d)
    gz = spark.read.format("binaryFile").load(feed_glob(root))
    write_feed_zip(gz, root).write.format("noop").mode("overwrite").save()  # writes one archive per folder
    good, _bad = split_corrupt(read_feed_zip(spark, root, kind=None))
    return _with_n_tests(good).select(*FEED_COLS)


@query
def q_feed_infer(spark, d):
    """Schema inferred from the data (dates stay text, as autodetect would see them)."""
    root = fx.write_feed_fixture(spark, d)
    return read_feed(spark, root, kind=None, schema=None).select(
        "registration", "modification", "lastMotTestDate", "feed_date")


@query
def q_feed_limit(spark, d):
    """The first 100 records of the bulk feed by registration (a sample load)."""
    root = fx.write_feed_fixture(spark, d)
    return read_feed(spark, root, kind="bulk", limit=100, limit_order=["registration"]).select("registration", "feed_date")


# ---- sinks (SNK1-SNK3, SNK6, SNK8) ------------------------------------------------
@query
def q_table_append_overwrite(spark, d):
    path = scratch_dir(spark, "table")
    main, prepared = _merge_inputs(spark, d)
    cols = ["registration", "modification", "last_test_result", "mileage", "vehicle_age"]
    write_table(prepared.select(*cols), path, "overwrite")   # replaced by the next overwrite
    write_table(main.select(*cols), path, "overwrite")
    write_table(prepared.select(*cols), path, "append")
    return spark.read.parquet(path)


@query
def q_main_by_day(spark, d):
    path = scratch_dir(spark, "main")
    create_main(_enriched_history(spark, d).drop("motTests"), path)
    return spark.read.parquet(path).groupBy("p_day").agg(F.count(F.lit(1)).alias("vehicles"))


@query
def q_counts_by_month(spark, d):
    path = scratch_dir(spark, "counts")
    counts = fx.series_counts(spark, d)
    write_daily_counts(counts, path)
    # a refresh from the middle of a month: the table holds the last run only
    write_daily_counts(counts.where(F.col("test_date") >= F.lit("2001-05-10").cast("timestamp_ntz")), path)
    return spark.read.parquet(path).select("test_date", "result_type", "count", "p_month")


@query
def q_flat_export(spark, d):
    """Written as CSV and read back (quotes doubled), all 15 columns."""
    path = scratch_dir(spark, "flat")
    write_csv(fx.history(spark, d), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    text = [F.coalesce(c, F.lit("")).alias(c) for c in back.columns if c != "motTestCount"]
    return back.select(*text, F.col("motTestCount").cast("int"))


@query
def q_versioned_upsert(spark, d):
    """Upsert written as a new table version next to the old one, read back."""
    path = scratch_dir(spark, "versioned")
    main, prepared = _merge_inputs(spark, d)
    write_version(main, path)
    current = read_latest(spark, path)
    write_version(upsert(current, prepared), path)
    return _with_n_tests(read_latest(spark, path)).select(*UPSERT_COLS)


# ---- classifier (ML1-ML9, A6, P8, P13, P14) -------------------------------------
def _training_set(spark, d):
    return pass_fail_training(_enriched_history(spark, d))


@query
def q_pass_fail_training(spark, d):
    return _training_set(spark, d)


@query
def q_class_weights(spark, d):
    return class_weights(_training_set(spark, d)).withColumn("weight", F.round("weight", 6))


@query
def q_pass_probability(spark, d):
    """PASSED probability out of per-label probability arrays built from pass/fail shares."""
    h = _enriched_history(spark, d)
    total = F.col("pass_count") + F.col("fail_count")
    probs = F.when(total > 0, F.array(
        F.struct(F.lit("FAILED").alias("label"), (F.col("fail_count") / total).alias("prob")),
        F.struct(F.lit("PASSED").alias("label"), (F.col("pass_count") / total).alias("prob"))))
    return h.select("registration", F.round(pass_probability(probs), 6).alias("pass_probability"))


def _lookup_keys(spark, d):
    # vehicles named in the change feed, looked up in the full history
    return fx.delta(spark, d).select("registration")


@query
def q_lookup(spark, d):
    h = _enriched_history(spark, d).drop("motTests")
    return lookup(h, _lookup_keys(spark, d)).select(
        "registration", "mileage", "vehicle_age", "make", "model", "primaryColour")


def _model(spark, d, balance=True):
    # on one category, without a penalty and to convergence, the fitted probability
    # is the weighted share of passes of that category
    return fit_pass_fail(_training_set(spark, d), balance=balance, features=["make"], max_iter=200, tol=1e-12)


def _scored(df):
    return df.select(*[c for c in df.columns if c not in ("predicted_last_test_result_probs", "pass_probability")],
                     F.round("pass_probability", 4).alias("pass_probability"))


@query
def q_model_round_trip(spark, d):
    """Fit, replace the stored model (save with overwrite), load it back and score."""
    path = scratch_dir(spark, "model")
    save_model(_model(spark, d), path)
    save_model(_model(spark, d, balance=False), path)  # replace
    h = _enriched_history(spark, d)
    return _scored(score(load_model(path), h.select("registration", *FEATURES))).select(
        "registration", "predicted_last_test_result", "pass_probability")


@query
def q_score(spark, d):
    h = _enriched_history(spark, d)
    return _scored(score(_model(spark, d), h.select("registration", *FEATURES))).select(
        "registration", "predicted_last_test_result", "pass_probability")


@query
def q_score_all_features(spark, d):
    """All features: every vehicle gets a probability, those without a mileage too."""
    model = fit_pass_fail(_training_set(spark, d))
    h = _enriched_history(spark, d)
    p = F.col("pass_probability")
    return score(model, h.select("registration", *FEATURES)).select(
        "registration", (~F.isnan(p) & p.between(0.0, 1.0)).alias("has_probability"))


@query
def q_lookup_score(spark, d):
    h = _enriched_history(spark, d)
    return _scored(lookup_score(_model(spark, d), h, _lookup_keys(spark, d)))


@query
def q_what_if_score(spark, d):
    """One scenario of the dashboard: parameters in, probability out."""
    scenario = what_if(spark, 40_000, 7, "Machinery", "any", "blue")
    return _scored(what_if_score(_model(spark, d), scenario))


@query
def q_score_hashed(spark, d):
    """All features, categories hashed: the pipeline's probability of each vehicle and the
    one that joins and sums over the stored weights give agree."""
    main = _enriched_history(spark, d)
    model = fit_pass_fail(pass_fail_training(main), buckets=64)
    path = scratch_dir(spark, "weights")
    write_table(model_weights(model), path, "overwrite")
    plain = score_by_weights(spark.read.parquet(path), main, 64).withColumnRenamed("pass_probability", "p")
    got = score(model, main.drop("motTests")).select("registration", "pass_probability")
    return got.join(plain, "registration").select(
        "registration", (F.abs(F.col("pass_probability") - F.col("p")) < 1e-9).alias("agree"),
        ((F.col("p") > 0) & (F.col("p") < 1)).alias("is_probability"))


# ---- streams (SRC9, STR1-STR3) and end-to-end jobs --------------------------------
@query
def q_stream_ingest(spark, d):
    """Feed folders ingested by a file stream (availableNow), rerun, read back."""
    root = fx.write_feed_fixture(spark, d)
    sink, ckpt = scratch_dir(spark, "stream-sink"), scratch_dir(spark, "stream-ckpt")
    for _ in range(2):  # the second run finds no new file
        ingest(stream_feed(spark, root, kind=None), sink, ckpt).awaitTermination()
    good, _bad = split_corrupt(spark.read.parquet(sink))
    return _with_n_tests(good).select(*FEED_COLS)


def _zipped_feed(spark, d):
    """The feed's folders packed into one archive each, in a folder of their own."""
    root = scratch_dir(spark, "feed-zips")
    gz = spark.read.format("binaryFile").load(feed_glob(fx.write_feed_fixture(spark, d)))
    hadoop_path(spark, root)[0].mkdirs(hadoop_path(spark, root)[1])
    write_feed_zip(gz, root).write.format("noop").mode("overwrite").save()
    return root


@query
def q_read_zips(spark, d):
    """Archives read through the data source, one partition per member."""
    good, _bad = split_corrupt(read_zips(spark, _zipped_feed(spark, d), kind=None))
    return _with_n_tests(good).select(*FEED_COLS)


@query
def q_stream_ingest_zips(spark, d):
    """Archives as a stream, each read once: the second run adds nothing."""
    root = _zipped_feed(spark, d)
    sink, ckpt = scratch_dir(spark, "zip-sink"), scratch_dir(spark, "zip-ckpt")
    for _ in range(2):
        ingest(stream_zips(spark, root, kind=None), sink, ckpt).awaitTermination()
    good, _bad = split_corrupt(spark.read.parquet(sink))
    return _with_n_tests(good).select(*FEED_COLS)


@query
def q_stream_upsert(spark, d):
    """Delta folders applied by foreachBatch upserts to a versioned main table."""
    root = fx.write_feed_fixture(spark, d)
    table, ckpt = scratch_dir(spark, "stream-main"), scratch_dir(spark, "stream-upsert-ckpt")
    write_version(fx.main_table(spark, d, fx.AS_OF_DELTA), table)
    for _ in range(2):
        start_upsert(stream_feed(spark, root, kind="delta"), table, ckpt, fx.AS_OF_DELTA).awaitTermination()
    return _with_n_tests(read_latest(spark, table)).select(*UPSERT_COLS)


@query
def q_stream_log(spark, d):
    """Delta folders, the later one found first, one file per batch: keyed state lets the
    newest record of each vehicle win whatever the order; read merged with main."""
    path, ckpt, root = scratch_dir(spark, "stream-log"), scratch_dir(spark, "stream-log-ckpt"), scratch_dir(spark, "stream-log-feed")
    changelog.create(fx.main_table(spark, d, fx.AS_OF_DELTA), path, buckets=8)
    e = fx.delta(spark, d).select(*VEHICLE.fieldNames())
    split = F.lit(fx.DELTA_SPLIT).cast("timestamp_ntz")
    for folder, rows in ((fx.DELTA_NEW_FOLDER, e.where(F.col("lastMotTestDate") >= split)), (fx.DELTA_OLD_FOLDER, e.where(F.col("lastMotTestDate") < split))):
        write_feed(rows, root, folder)
        start_log(stream_feed(spark, root, kind="delta", max_files_per_trigger=2), path, ckpt, fx.AS_OF_DELTA).awaitTermination()
    return _with_n_tests(changelog.read(spark, path, in_turn=False)).select(*UPSERT_COLS)


@query
def q_budget_overruns(spark, d):
    return budget_overruns(fx.budget_envelopes(spark, d)).select("event_id", "costAmount", "budgetAmount")


@query
def q_weekly_delta_ingest(spark, d):
    """Two weeks of delta folders, each applied by its own run, then a run without new
    files.  The second week changes and deletes vehicles that the first changed, some by
    records without a date; a vehicle must not come back."""
    root, table, ckpt = (scratch_dir(spark, n) for n in ("weekly-feed", "weekly-main", "weekly-ckpt"))
    write_version(fx.main_table(spark, d, fx.AS_OF_DELTA), table)
    first, second = fx.weekly_folders(spark, d)
    for folder, rows in ((fx.DELTA_OLD_FOLDER, first), (fx.DELTA_NEW_FOLDER, second)):
        write_feed(rows, root, folder)
        weekly_delta_ingest(spark, root, table, ckpt, fx.AS_OF_DELTA)
    if weekly_delta_ingest(spark, root, table, ckpt, fx.AS_OF_DELTA):
        raise AssertionError("a run without new files must not change the table")
    return _with_n_tests(read_latest(spark, table)).select(*UPSERT_COLS)


def _weeks(spark, d):
    return [prepare_delta(w, fx.AS_OF_DELTA) for w in fx.weekly_folders(spark, d)]


@query
def q_changelog_read(spark, d):
    """Two weeks appended to a change log, read merged with main."""
    path = scratch_dir(spark, "changelog")
    changelog.create(fx.main_table(spark, d, fx.AS_OF_DELTA), path, buckets=8)
    for week in _weeks(spark, d):
        changelog.append(week, path)
    return _with_n_tests(changelog.read(spark, path)).select(*UPSERT_COLS)


@query
def q_changelog_compacted(spark, d):
    """The same, some buckets compacted after the first week and all after the second."""
    path = scratch_dir(spark, "changelog")
    changelog.create(fx.main_table(spark, d, fx.AS_OF_DELTA), path, buckets=8)
    for week, buckets in zip(_weeks(spark, d), ([1, 2, 5], None)):
        changelog.append(week, path)
        changelog.compact(spark, path, buckets)
    if changelog.manifest(spark, path).log:
        raise AssertionError("no bucket waits for a delta")
    return _with_n_tests(changelog.read(spark, path)).select(*UPSERT_COLS)


@query
def q_counts_incremental(spark, d):
    """Counts of main kept up to date over two weekly merges, not counted again."""
    main = fx.main_table(spark, d, fx.AS_OF_DELTA)
    counts, table = all_counts(main), scratch_dir(spark, "counted-main")
    for week in _weeks(spark, d):
        counts = apply_changes(counts, count_changes(main, week))
        write_version(upsert(main, week, duplicates="trust"), table)
        main = read_latest(spark, table)
    return counts


@query
def q_weekly_rows_affected(spark, d):
    """The rows affected that a weekly run returns."""
    root, table, ckpt = (scratch_dir(spark, n) for n in ("weekly-feed", "weekly-main", "weekly-ckpt"))
    write_version(fx.main_table(spark, d, fx.AS_OF_DELTA), table)
    write_feed(fx.delta(spark, d).select(*VEHICLE.fieldNames()), root, fx.DELTA_NEW_FOLDER)
    got = weekly_delta_ingest(spark, root, table, ckpt, fx.AS_OF_DELTA)
    return spark.createDataFrame([(a, n) for _, a, n in got], "action string, rows bigint")


@query
def q_prediction_view(spark, d):
    """Counts and AR(1) forecast registered as views; the chart view read back by name."""
    frames = {"daily_counts_f3": _f3(spark, d), "forecast_f3": _ar1_forecast(spark, d)}
    register_views(spark, frames)
    view = prediction_output(spark.table("daily_counts_f3"), spark.table("forecast_f3"), fx.AS_OF_HISTORY)
    register_views(spark, {"prediction_output_f3": view})
    return spark.table("prediction_output_f3").withColumn("count", F.round("count", 4))


@query
def q_analytics_chain(spark, d):
    """main -> daily counts -> training -> forecast -> stored tables -> chart view."""
    frames = analytics(_enriched_history(spark, d), fx.AS_OF_HISTORY)
    counts, fc = scratch_dir(spark, "chain-counts"), scratch_dir(spark, "chain-forecast")
    write_daily_counts(frames["daily_counts"], counts)
    write_table(frames["forecast"], fc, "overwrite")
    name = "prediction_output_" + counts.rsplit("-", 1)[-1]
    create_chart_view(spark, name, counts, fc, fx.AS_OF_HISTORY)
    return _rounded(spark.table(name))


@query
def q_read_latest_feed(spark, d):
    """Newest delta folder only, chosen from the file listing."""
    root = fx.write_feed_fixture(spark, d)
    return _with_n_tests(read_latest_feed(spark, root, kind="delta")).select(*FEED_COLS)


# ---- further jobs and layouts -------------------------------------------------------
@query
def q_upsert_bucketed(spark, d):
    """Full-outer merge against a main table bucketed by registration (main not shuffled)."""
    main, prepared = _merge_inputs(spark, d)
    path = scratch_dir(spark, "main-bucketed")
    table = "inspecta_main_" + path.rsplit("-", 1)[-1]
    write_bucketed(main, table, path, buckets=8)
    out = upsert(spark.table(table), prepared, buckets=8)
    return _with_n_tests(out).select(*UPSERT_COLS)


@query
def q_bulk_load(spark, d):
    """Bulk feed folder -> enrich -> first version of the main table, read back."""
    root = fx.write_feed_fixture(spark, d)
    table = scratch_dir(spark, "bulk-main")
    bulk_load(spark, root, table, fx.AS_OF_HISTORY)
    return _with_n_tests(read_latest(spark, table)).select(*ENRICH_COLS)


@query
def q_normalise_feed(spark, d):
    """Feed folders rewritten as one NDJSON dataset per folder with the date tag."""
    root = fx.write_feed_fixture(spark, d)
    out = normalise_feed(spark, root, scratch_dir(spark, "normalised"))
    schema = T.StructType(VEHICLE.fields + [T.StructField("date", T.StringType()),
                                            T.StructField("folder", T.StringType())])
    back = spark.read.schema(schema).json(out)
    return _with_n_tests(back).select("registration", "modification", "lastMotTestDate", "date",
                                      "folder", "n_tests")


@query
def q_budget_overruns_stream(spark, d):
    """Budget alerts as a file stream (availableNow) into a parquet sink, read back."""
    src, sink, ckpt = (scratch_dir(spark, n) for n in ("budget-in", "budget-out", "budget-ckpt"))
    fx.budget_envelopes(spark, d).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema("event_id bigint, data string").parquet(src)
    q = (budget_overruns(stream).select("event_id", "costAmount", "budgetAmount")
         .writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
