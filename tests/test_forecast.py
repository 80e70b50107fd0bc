import datetime as dt

import math

import pytest
from pyspark.sql import functions as F

from inspecta.functions.calendar import gb_holidays
from inspecta.operators.counts import daily_counts
from inspecta.operators.forecast import (
    ar1_baseline, clean_seasonal_spikes, clean_spikes, evaluate_forecast, fill_daily, fit_forecast, forecast, forecast_training,
    prediction_output, training_cutoff,
)

D = dt.date


def _series(spark, rows):
    return spark.createDataFrame(rows, "test_date date, result_type string, count bigint")


def test_fill_daily_interpolates(spark):
    df = _series(spark, [(D(2024, 1, 1), "A", 10), (D(2024, 1, 4), "A", 40), (D(2024, 1, 2), "B", 5)])
    got = {(r.result_type, r.test_date): (r["count"], r.filled) for r in fill_daily(df).collect()}
    assert got[("A", D(2024, 1, 2))] == (20.0, True)
    assert got[("A", D(2024, 1, 3))] == (30.0, True)
    assert got[("A", D(2024, 1, 4))] == (40.0, False)
    assert len([k for k in got if k[0] == "B"]) == 1


def test_clean_spikes_replaces_outlier(spark):
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), "A", 10 + (i % 2)) for i in range(15)]
    rows[7] = (rows[7][0], "A", 500)
    out = {r.test_date: (r["count"], r.is_spike) for r in clean_spikes(_series(spark, rows)).collect()}
    assert out[rows[7][0]][1] is True and out[rows[7][0]][0] < 20
    assert sum(1 for v in out.values() if v[1]) == 1


def test_no_complete_date_gives_empty_training(spark):
    c = spark.createDataFrame([(dt.datetime(2024, 1, 1), "PASSED", 3)],
                              "test_date timestamp_ntz, result_type string, count bigint")
    assert training_cutoff(c).first()["cutoff"] is None
    assert forecast_training(c, D(2024, 2, 1)).count() == 0


def test_day_grain_equals_reaggregated_timestamp_grain(spark):
    rows = [(dt.datetime(2024, 1, 30, h), "PASSED" if h % 2 else "FAILED") for h in range(10)]
    df = spark.createDataFrame(rows, "last_test_date timestamp_ntz, last_test_result string")
    ts = daily_counts(df, D(2024, 2, 1), grain="timestamp")
    re = ts.groupBy(F.to_date("test_date").alias("d"), "result_type").agg(F.sum("count").alias("n"))
    day = daily_counts(df, D(2024, 2, 1), grain="day").select(F.to_date("test_date").alias("d"), "result_type",
                                                               F.col("count").alias("n"))
    assert re.exceptAll(day).count() == 0 and day.exceptAll(re).count() == 0
    assert daily_counts(df, D(2024, 4, 30)).count() == 0   # older than 60 days


def _days(spark, values, name="A", first=D(2024, 1, 1)):
    return _series(spark, [(first + dt.timedelta(days=i), name, int(v)) for i, v in enumerate(values)])


def _path(spark, values, horizon):
    fits = fit_forecast(_days(spark, values))
    chosen = [r.model for r in fits.where("chosen").collect()]
    return chosen, [r.forecast_value for r in forecast(fits, horizon).orderBy("forecast_timestamp").collect()]


def test_constant_series(spark):
    chosen, path = _path(spark, [7] * 60, 30)
    assert chosen == ["drift"] and path == [7.0] * 30


def test_weekly_pattern_is_recovered(spark):
    week = [100, 120, 90, 100, 130, 60, 75]
    chosen, path = _path(spark, week * 12, 14)
    assert chosen == ["weekday"] and path == pytest.approx(week * 2)


def test_trend_and_mean_reversion(spark):
    chosen, path = _path(spark, [3 * i for i in range(40)], 5)
    assert path == pytest.approx([117 + 3 * h for h in range(1, 6)])
    y = [1000.0]
    for _ in range(30):
        y.append(round(50 + 0.5 * y[-1]))
    chosen, path = _path(spark, y, 3)
    assert chosen == ["ar1"] and path[-1] == pytest.approx(100, abs=2)


def test_short_series(spark):
    for values, models in (([5], set()), ([5, 6], set()), ([], set()), ([10, 14, 9, 30], set()), ([10, 14, 9, 30, 12], {"drift"}),
                           ([10, 14, 9, 30, 12, 17], {"drift", "ar1"}), ([10, 14, 9, 30, 12, 17, 20] * 2, {"drift", "ar1"}),
                           ([10, 14, 9, 30, 12, 17, 20] * 2 + [11], {"drift", "ar1", "weekday"})):
        fits = fit_forecast(_days(spark, values))
        usable = {r.model for r in fits.where("aicc is not null").collect()}
        assert usable == models and fits.where("chosen").count() == min(1, len(models))
        ahead = forecast(fits, 8).collect()
        assert len(ahead) == 8 * min(1, len(models))
        assert all(r.forecast_value is not None and (r.standard_error > 0 or "weekday" in models) for r in ahead)


def test_weekly_dips_stay_and_real_spikes_go(spark):
    week = [100, 120, 90, 100, 130, 20, 5]
    plain = _days(spark, week * 8)
    assert clean_seasonal_spikes(plain).where("is_spike").count() == 0
    assert [r["count"] for r in clean_seasonal_spikes(plain).orderBy("test_date").collect()] == week * 8
    values = week * 8
    values[24], values[40] = 900, 0
    got = clean_seasonal_spikes(_days(spark, values)).orderBy("test_date").collect()
    assert [i for i, r in enumerate(got) if r.is_spike] == [24, 40]
    assert [r["count"] for r in got] == week * 8
    rising = [2 * i + v for i, v in enumerate(week * 8)]
    assert clean_seasonal_spikes(_days(spark, rising)).where("is_spike").count() <= 4      # at the ends a frame is one-sided


def test_evaluation_compares_models(spark):
    rows = evaluate_forecast(fit_forecast(_days(spark, [i * i % 11 + i for i in range(50)]))).collect()
    assert {r.model for r in rows} == {"ar1", "drift", "weekday"} and {r.n for r in rows} == {49}
    assert [r.aicc for r in rows if r.chosen] == [min(r.aicc for r in rows)]
    for r in rows:
        assert r.log_likelihood == pytest.approx(-r.n / 2 * (math.log(2 * math.pi * r.sigma2) + 1))


def test_ar1_over_a_gap(spark):
    df = _series(spark, [(D(2024, 1, 1), "A", 1), (D(2024, 1, 2), "A", 2), (D(2024, 1, 6), "A", 6)])
    p = ar1_baseline(fill_daily(df)).first()
    assert (p.phi, p.c, p.n) == (pytest.approx(1.0), pytest.approx(1.0), 6)


def test_fit_forecast_gives_horizon_per_series_and_blend_is_non_negative(spark):
    rows = []
    for i in range(90):
        day = D(2024, 1, 1) + dt.timedelta(days=i)
        rows += [(day, "PASSED", 50 + (i % 7) * 3), (day, "FAILED", max(0, 5 - (i % 7)))]
    train = _series(spark, rows)
    fc = forecast(fit_forecast(train), horizon=30)
    per = {r.result_type: r.n for r in fc.groupBy("result_type").agg(F.countDistinct("forecast_timestamp").alias("n")).collect()}
    assert per == {"PASSED": 30, "FAILED": 30}
    counts = train.select(F.col("test_date").cast("timestamp_ntz").alias("test_date"), "result_type", "count")
    blend = prediction_output(counts, fc, D(2024, 3, 31))
    assert blend.where(F.col("count") < 0).count() == 0
    assert blend.where(F.col("chart_series").endswith("FORECAST")).count() == 60


def test_null_forecast_stays_null(spark):
    fc = spark.createDataFrame([(dt.datetime(2024, 2, 2), "PASSED", None), (dt.datetime(2024, 2, 3), "PASSED", -4.0)],
                               "forecast_timestamp timestamp_ntz, result_type string, forecast_value double")
    counts = spark.createDataFrame([], "test_date timestamp_ntz, result_type string, count bigint")
    got = sorted((r.test_date, r["count"]) for r in prediction_output(counts, fc, D(2024, 2, 1)).collect())
    assert got == [(D(2024, 2, 2), None), (D(2024, 2, 3), 0.0)]


def test_gb_holidays_2024_and_substitutes(spark):
    got = {r.holiday_name: r.holiday_date for r in gb_holidays(spark, 2024, 2024).collect()}
    assert got == {"NewYear": D(2024, 1, 1), "GoodFriday": D(2024, 3, 29), "EasterMonday": D(2024, 4, 1),
                   "EarlyMayBankHoliday": D(2024, 5, 6), "SpringBankHoliday": D(2024, 5, 27),
                   "SummerBankHoliday": D(2024, 8, 26), "Christmas": D(2024, 12, 25),
                   "BoxingDay": D(2024, 12, 26)}
    y21 = {r.holiday_name: r.holiday_date for r in gb_holidays(spark, 2021, 2022).collect() if r.holiday_date.year == 2021}
    assert y21["Christmas"] == D(2021, 12, 27) and y21["BoxingDay"] == D(2021, 12, 28)
    y22 = {r.holiday_name: r.holiday_date for r in gb_holidays(spark, 2022, 2022).collect()}
    assert y22["NewYear"] == D(2022, 1, 3) and y22["Christmas"] == D(2022, 12, 27)
    assert y22["BoxingDay"] == D(2022, 12, 26) and y22["GoodFriday"] == D(2022, 4, 15)


def test_holidays_cover_the_series_own_years(spark):
    from inspecta.operators.forecast import with_holidays
    df = _series(spark, [(D(1955, 12, 27), "A", 1), (D(2140, 1, 1), "A", 2)])
    got = {r.test_date: r.holiday_name for r in with_holidays(df).collect()}
    assert got == {D(1955, 12, 27): "Christmas", D(2140, 1, 1): "NewYear"}


def test_standard_errors(spark):
    fits = fit_forecast(_days(spark, [10, 12, 9, 15, 11, 18, 13, 20, 16, 22, 18, 25]))
    by = {r.model: r for r in fits.collect()}
    for model in by:
        only = fits.withColumn("chosen", F.col("model") == model)
        se = [r.standard_error for r in forecast(only, 3).orderBy("forecast_timestamp").collect()]
        s2, phi = by[model].sigma2, by[model].phi
        growth = {"weekday": [1, 1, 1], "drift": [1, 2, 3]}.get(model) or [sum(phi ** (2 * i) for i in range(h)) for h in (1, 2, 3)]
        assert se == pytest.approx([math.sqrt(s2 * g) for g in growth])


def test_forecast_intervals_bracket_the_value(spark):
    rows = []
    for i in range(90):
        day = D(2024, 1, 1) + dt.timedelta(days=i)
        rows += [(day, "PASSED", 50 + (i % 7) * 3 + (i * 7919) % 5)]
    fc = forecast(fit_forecast(_series(spark, rows)), horizon=10).collect()
    assert len(fc) == 10
    for r in fc:
        assert r.prediction_interval_lower_bound < r.forecast_value < r.prediction_interval_upper_bound
        assert r.confidence_level == 0.95
