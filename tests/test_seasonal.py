"""Regression with autoregressive errors against plain numpy, and on short and odd series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from inspecta.operators.seasonal import (
    COLUMNS, KPSS_LEVEL, MAX_ORDER, SETS, TWO_WEEKS, design, effects, search_orders, seasonal_forecast,
)
from inspecta.functions.calendar import gb_holidays

D = dt.date
FIRST = D(2023, 12, 1)


def _days(spark, series):
    rows = [(first + dt.timedelta(days=i), name, float(v)) for name, (first, values) in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "test_date date, result_type string, count double")


def _x(day, holidays):
    names = holidays.get(day, set())
    weekday = day.isoweekday() % 7 + 1
    return [1.0, *[float(weekday == d) for d in range(2, 8)], *[float(c in names) for c in COLUMNS[7:]]]


def brute(first, values, holidays, horizon):
    """(chosen key, all aicc by key, forecast, standard errors) by least squares and Yule-Walker equations."""
    days = [first + dt.timedelta(days=i) for i in range(len(values))]
    raw_x, raw_y = np.array([_x(d, holidays) for d in days]), np.array(values, float)
    fits = {}
    for d in (0, 1):
        y, x = (raw_y, raw_x) if d == 0 else (np.diff(raw_y), np.diff(raw_x, axis=0))
        if d:
            x = np.concatenate([np.ones((len(x), 1)), x[:, 1:]], axis=1)
        n = len(y)
        if not n:
            continue
        for name, size in SETS.items():
            beta = np.linalg.lstsq(x[:, :size], y, rcond=None)[0]
            rank = np.linalg.matrix_rank(x[:, :size])
            u = y - x[:, :size] @ beta
            g = np.array([u[h:] @ u[:n - h] / n if h < n else 0 for h in range(MAX_ORDER + 1)])
            for p in range(MAX_ORDER + 1):
                if p and g[0] > 1e-9:
                    phi = np.linalg.lstsq(g[np.abs(np.subtract.outer(range(p), range(p)))], g[1:p + 1], rcond=None)[0]
                else:
                    phi = np.zeros(p)
                v = g[0] - phi @ g[1:p + 1]
                k = rank + p + 1
                ok = n - k - 1 > 0 and (name == "level" or n >= TWO_WEEKS)
                aicc = n * (math.log(2 * math.pi * max(v, 1e-12)) + 1) + 2 * k + 2 * k * (k + 1) / (n - k - 1) if ok else None
                fits[d, name, p] = (aicc, beta, phi, v * n / (n - k + 1) if n - k + 1 > 0 else None, u, g, size)
    u, g = fits[0, "level", 0][4:6]
    n = len(u)
    width = min(MAX_ORDER, int(4 * (n / 100) ** 0.25))
    long_run = g[0] + 2 * sum(g[h] * (1 - h / (width + 1)) for h in range(1, width + 1))
    kpss = (np.cumsum(u) ** 2).sum() / n / n / long_run if long_run > 1e-12 else 0
    use = int(kpss > KPSS_LEVEL)
    may = {k: f for k, f in fits.items() if k[0] == use and f[0] is not None}
    if not may:
        return None, fits, [], []
    key = min(may, key=lambda k: (round(may[k][0], 6), SETS[k[1]] + k[2]))
    _, beta, phi, s2, u, _, size = may[key]
    past, psi, out, se = list(u[::-1]) + [0.0] * MAX_ORDER, [1.0] + [0.0] * MAX_ORDER, [], []
    total, weights = 0.0, []
    for h in range(1, horizon + 1):
        new = sum(a * b for a, b in zip(phi, past))
        past = [new, *past]
        total = total + new if use else new
        x = np.array(_x(days[-1] + dt.timedelta(days=h), holidays))
        if use:
            x = x - raw_x[-1]
            x[0] = h
        out.append((raw_y[-1] if use else 0) + x[:size] @ beta + total)
        weights.append(sum(psi[:h]) if use else psi[0])
        psi = [sum(a * b for a, b in zip(phi, psi)), *psi]
        se.append(math.sqrt(s2 * sum(w * w for w in weights)))
    return key, fits, out, se


def series():
    rng = np.random.default_rng(3)
    week = np.array([100, 160, 150, 155, 170, 140, 90])
    noise = [0.0]
    for _ in range(1100):
        noise.append(0.6 * noise[-1] + rng.normal(0, 5))
    noise = np.array(noise)
    out = {"ar": (FIRST, 50 + noise[:200]), "week": (FIRST, np.tile(week, 30)[:200] + noise[:200]),
           "walk": (FIRST, 500 + np.cumsum(rng.normal(0.5, 3, 300))), "trend": (FIRST, 3.0 * np.arange(80) + rng.normal(0, 1, 80)),
           "constant": (FIRST, np.full(60, 7.0)), "pure": (FIRST, np.tile(week, 20)[:100])}
    days = [D(2021, 6, 1) + dt.timedelta(days=i) for i in range(1000)]
    hol = {r.holiday_date for r in HOLIDAY_ROWS}
    out["holidays"] = (days[0], [200 + 30 * (d.weekday() < 5) - 150 * (d in hol) + noise[i] for i, d in enumerate(days)])
    for n in range(1, 16):
        out[f"young{n:02d}"] = (FIRST, np.array([10, 14, 9, 30, 12, 18, 25, 11, 9, 8, 31, 22, 17, 5, 21])[:n])
    return out


HOLIDAY_ROWS = []


@pytest.fixture(scope="module")
def fitted(spark):
    HOLIDAY_ROWS.extend(gb_holidays(spark, 2019, 2026).collect())
    holidays = {}
    for r in HOLIDAY_ROWS:
        holidays.setdefault(r.holiday_date, set()).add(r.holiday_name)
    every = series()
    fits = search_orders(_days(spark, every)).checkpoint()
    return every, holidays, fits


def test_fits_and_forecasts_equal_numpy(fitted):
    every, holidays, fits = fitted
    rows, ahead = {}, {}
    for r in fits.collect():
        rows.setdefault(r.result_type, []).append(r)
    for r in seasonal_forecast(fits, 20).orderBy("forecast_timestamp").collect():
        ahead.setdefault(r.result_type, []).append(r)
    for name, (first, values) in every.items():
        key, want, path, se = brute(first, values, holidays, 20)
        got = {(r.d, r.regressors, r.p): r for r in rows[name]}
        assert set(got) == set(want)
        for k, r in got.items():
            if want[k][0] is None:
                assert r.aicc is None, (name, k)
            elif want[k][3] > 1e-6:
                assert r.aicc == pytest.approx(want[k][0], rel=1e-6, abs=1e-4), (name, k)
                assert r.sigma2 == pytest.approx(want[k][3], rel=1e-6)
        chosen = [k for k, r in got.items() if r.chosen]
        if name in ("constant", "pure"):      # several models without error
            assert len(chosen) == 1
        else:
            assert chosen == ([key] if key else []), name
            assert [r.forecast_value for r in ahead.get(name, [])] == pytest.approx(path, rel=1e-6, abs=1e-6), name
            assert [r.standard_error for r in ahead.get(name, [])] == pytest.approx(se, rel=1e-6, abs=1e-6), name


def test_what_is_chosen(fitted):
    every, holidays, fits = fitted
    chosen = {r.result_type: (r.d, r.regressors, r.p) for r in fits.where("chosen").collect()}
    assert chosen["ar"][0] == 0 and chosen["ar"][1] == "level" and chosen["ar"][2] >= 1
    assert chosen["week"][1] == "week" and chosen["pure"][1] == "week" and chosen["constant"] == (0, "level", 0)
    assert chosen["walk"][0] == 1 and chosen["trend"][0] == 1
    assert chosen["holidays"][1] == "week_holidays"
    effect = {r.effect_of: r.effect for r in effects(fits.where("result_type = 'holidays'")).collect()}
    assert all(effect[h] == pytest.approx(-150, abs=25) for h in COLUMNS[7:])
    assert effect["weekday2"] == pytest.approx(30, abs=5) and abs(effect["weekday7"]) < 5


def test_holidays_act_on_the_days_ahead(fitted):
    _, _, fits = fitted
    ahead = seasonal_forecast(fits.where("result_type = 'holidays'"), 60).collect()      # from 25 Feb 2024
    by = {r.forecast_timestamp.date(): r.forecast_value for r in ahead}
    assert by[D(2024, 3, 29)] < by[D(2024, 3, 22)] - 100 and by[D(2024, 4, 1)] < by[D(2024, 4, 8)] - 100


def test_young_series_have_errors_and_no_nulls(fitted):
    _, _, fits = fitted
    ahead = seasonal_forecast(fits, 30).where("result_type like 'young%'").collect()
    names = {r.result_type for r in ahead}
    assert names == {f"young{n:02d}" for n in range(4, 16)} and len(ahead) == 30 * len(names)
    assert all(r.forecast_value is not None and r.standard_error > 0 for r in ahead)
    assert fits.where("result_type < 'young04' and result_type like 'young%' and aicc is not null").count() == 0


def test_pure_week_goes_on(fitted):
    _, _, fits = fitted
    got = [r.forecast_value for r in seasonal_forecast(fits.where("result_type = 'pure'"), 14).orderBy("forecast_timestamp").collect()]
    week = [100, 160, 150, 155, 170, 140, 90]
    assert got == pytest.approx([week[(100 + i) % 7] for i in range(14)])


def test_given_calendar_and_empty_input(spark):
    cal = spark.createDataFrame([(D(2024, 1, 9), "Christmas"), (D(2024, 1, 9), "BoxingDay"), (D(2024, 1, 9), "Fair")],
                                "holiday_date date, holiday_name string")
    days = design(_days(spark, {"a": (D(2024, 1, 8), [1, 2, 3])}), calendar=cal).where("d = 0").orderBy("test_date").collect()
    assert [sum(r.x[7:]) for r in days] == [0, 2, 0]          # one row a day, names that are no columns have no effect
    none = _days(spark, {"a": (FIRST, [1])}).where("false")
    fits = search_orders(none)
    assert fits.count() == 0 and seasonal_forecast(fits).count() == 0


def test_series_do_not_mix(spark):
    df = _days(spark, {"a": (FIRST, [5, 6, 7, 9, 8, 6, 7, 6])})
    one = search_orders(df).where("chosen").count()
    both = search_orders(df.unionByName(df.withColumn("result_type", F.lit("b")))).where("chosen").count()
    assert (one, both) == (1, 2)
