"""Daily forecasts with calendar effects: regression with autoregressive errors.

y_t = x_t . beta + u_t, where x holds a level, the weekday and the holidays of the day and
u is autoregressive of an order that is searched.  All series are fitted at once:

* Regression: the products of the (few) non-zero regressors of each day are summed per
  series, a partial aggregate, and the normal equations are eliminated in array
  expressions.  One sum serves three nested regressor sets (``SETS``).
* Differencing: a series whose residuals fail the KPSS test for a level is modelled by
  its daily differences.
* Order search: autocovariances of the residuals are aggregates over lagged rows; the
  Durbin-Levinson recursion, a fold over arrays, gives every order up to ``MAX_ORDER``.
  Set and order with the least corrected AIC are chosen; a model needs more days than
  parameters, and weekday sets need two weeks, so young series get small models.
* Forecast: recursions over the horizon as folds, the calendar joined to the days ahead.

A window holds one daily series; its size is bounded by the training span in days.
Everything that is kept per series is arrays of at most ``len(COLUMNS)`` squared numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inspecta.functions.calendar import gb_holidays
from inspecta.operators.forecast import MIN_VARIANCE
from inspecta.schema import HOLIDAYS

WEEKDAYS = (2, 3, 4, 5, 6, 7)       # of dayofweek; Sunday is part of the level
COLUMNS = ("level", *(f"weekday{d}" for d in WEEKDAYS), *HOLIDAYS)
SETS = {"level": 1, "week": 1 + len(WEEKDAYS), "week_holidays": len(COLUMNS)}     # nested: the first columns
MAX_ORDER = 7
TWO_WEEKS = 14                      # days that a set with weekdays needs
KPSS_LEVEL = 0.463                  # 5 % critical value of the test for a level
COLLINEAR = 1e-9                    # a pivot below this share of its sum of squares is none


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def _at(a: Column, i) -> Column:
    """Element of an array, counted from 0."""
    return F.get(a, F.lit(i) if isinstance(i, int) else i)


def calendar_of(df: DataFrame, first: Column, last: Column, calendar: DataFrame | None) -> DataFrame:
    """(holiday_date, names): one row a day.  Without a ``calendar`` the rule-based one is
    made for the years between and broadcast: 8 rows a year."""
    given = calendar is not None
    if not given:
        lo, hi = df.agg(F.year(F.min(first)), F.year(F.max(last))).first()
        calendar = gb_holidays(df.sparkSession, (lo or 1) - 1, (hi or 1) + 1)
    days = calendar.groupBy("holiday_date").agg(F.collect_set("holiday_name").alias("names"))
    return days if given else F.broadcast(days)


def regressors(day: Column, names: Column) -> Column:
    """x of a day, in the order of ``COLUMNS``."""
    one = lambda c: F.coalesce(c, F.lit(False)).cast("double")      # noqa: E731
    return F.array(F.lit(1.0), *[one(F.dayofweek(day) == d) for d in WEEKDAYS],
                   *[one(F.array_contains(names, h)) for h in HOLIDAYS])


def design(train: DataFrame, id_col: str = "result_type", date_col: str = "test_date", value_col: str = "count",
           calendar: DataFrame | None = None) -> DataFrame:
    """(result_type, d, test_date, y, x, raw_y, raw_x): each day as it is (d = 0) and as
    the difference to the day before (d = 1; the level column stays 1)."""
    rows = train.select(F.col(id_col).alias("result_type"), F.to_date(date_col).alias("test_date"),
                        F.col(value_col).cast("double").alias("raw_y"))
    cal = calendar_of(rows, F.col("test_date"), F.col("test_date"), calendar)
    rows = rows.join(cal, rows.test_date == cal.holiday_date, "left").select(
        "result_type", "test_date", "raw_y", regressors(F.col("test_date"), F.col("names")).alias("raw_x"))
    w = Window.partitionBy("result_type").orderBy("test_date")
    before = rows.select("*", F.lag("raw_y").over(w).alias("y0"), F.lag("raw_x").over(w).alias("x0"))
    step = F.transform(F.zip_with("raw_x", "x0", lambda a, b: a - b), lambda v, i: F.when(i == 0, 1.0).otherwise(v))
    forms = F.array(F.struct(F.lit(0).alias("d"), F.col("raw_y").alias("y"), F.col("raw_x").alias("x")),
                    F.struct(F.lit(1).alias("d"), (F.col("raw_y") - F.col("y0")).alias("y"), step.alias("x")))
    return (before.select("result_type", "test_date", "raw_y", "raw_x", F.inline(forms))
            .where("d = 0 or y is not null").select("result_type", "d", "test_date", "y", "x", "raw_y", "raw_x"))


def normal_equations(days: DataFrame) -> DataFrame:
    """(result_type, d, n, m): m is [X'X | X'y] as rows of numbers."""
    k = len(COLUMNS)
    used = F.filter(F.transform(F.concat("x", F.array("y")), lambda v, i: F.struct(i.alias("i"), v.alias("v"))),
                    lambda e: e["v"] != 0)
    pairs = F.flatten(F.transform(used, lambda a: F.transform(used, lambda b: F.struct(
        (a["i"] * (k + 1) + b["i"]).alias("at"), (a["v"] * b["v"]).alias("v")))))
    sums = (days.select("result_type", "d", F.inline(pairs)).groupBy("result_type", "d", "at").agg(F.sum("v").alias("v"))
            .groupBy("result_type", "d").agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("s")))
    cell = lambda i, j: F.coalesce(F.try_element_at("s", i * (k + 1) + j), F.lit(0.0))       # noqa: E731
    m = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(k)), lambda j: cell(i, j)))
    return sums.select("result_type", "d", cell(F.lit(0), F.lit(0)).cast("bigint").alias("n"), m.alias("m"))


def solve(m: Column, size: int) -> Column:
    """struct(beta, rank): least squares on the first ``size`` columns of [X'X | X'y] by
    elimination.  A column that the ones before it explain, or without values, gets 0."""
    k = len(COLUMNS)
    start = F.struct(m.alias("m"), F.array().cast("array<boolean>").alias("used"))

    def step(s: Column, j: Column) -> Column:
        row = _at(s["m"], j)
        pivot = _at(row, j)
        ok = pivot > F.lit(COLLINEAR) * _at(_at(m, j), j)
        scaled = F.transform(row, lambda v: F.try_divide(v, pivot))
        swept = F.transform(s["m"], lambda r, i: F.when(i == j, scaled).otherwise(
            F.zip_with(r, scaled, lambda a, b: a - _at(r, j) * b)))
        return F.struct(F.when(ok, swept).otherwise(s["m"]).alias("m"), F.concat(s["used"], F.array(ok)).alias("used"))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), start, step)
    beta = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.when(
        F.coalesce(_at(done["used"], j), F.lit(False)), _at(_at(done["m"], j), k)).otherwise(F.lit(0.0)))
    return F.struct(beta.alias("beta"), F.size(F.filter(done["used"], lambda u: u)).alias("rank"))


def regress(days: DataFrame) -> DataFrame:
    """(result_type, d, n, regressors, beta, rank): one row per regressor set."""
    # the elimination is deep in lambdas: its rows are made once
    eq = _cut(normal_equations(days))
    fits = F.array(*[F.struct(F.lit(name).alias("regressors"), solve(F.col("m"), size).alias("f")) for name, size in SETS.items()])
    return (eq.select("result_type", "d", "n", F.inline(fits))
            .select("result_type", "d", "n", "regressors", "f.beta", "f.rank"))


def autocovariances(days: DataFrame, fits: DataFrame, max_order: int = MAX_ORDER) -> DataFrame:
    """Per series, d and set: gamma (lags 0 to ``max_order``), kpss, and the last residuals,
    newest first, with the last day and its raw values."""
    u = days.join(fits, ["result_type", "d"]).select(
        "result_type", "d", "regressors", "n", "beta", "rank", "test_date", "raw_y", "raw_x", (F.col("y") - _dot(F.col("x"), F.col("beta"))).alias("u"))
    w = Window.partitionBy("result_type", "d", "regressors").orderBy("test_date")
    lags = [F.lag("u", h, 0.0).over(w).alias(f"u{h}") for h in range(1, max_order + 1)]
    upto = F.sum("u").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("upto")
    x = u.select("*", *lags, upto)
    us = [F.col("u"), *[F.col(f"u{h}") for h in range(1, max_order + 1)]]
    out = x.groupBy("result_type", "d", "regressors").agg(
        F.first("n").alias("n"), F.first("beta").alias("beta"), F.first("rank").alias("rank"),
        F.array(*[F.avg(F.col("u") * v) for v in us]).alias("gamma"),
        (F.sum(F.col("upto") * F.col("upto")) / F.count(F.lit(1)) / F.count(F.lit(1))).alias("spread"),
        F.max_by(F.array(*us[:max_order]), "test_date").alias("last_u"), F.max("test_date").alias("last_date"),
        F.max_by("raw_y", "test_date").alias("last_value"), F.max_by("raw_x", "test_date").alias("last_x"))
    # long-run variance with falling weights
    width = F.least(F.lit(max_order), F.floor(F.lit(4.0) * F.pow(F.col("n") / 100, F.lit(0.25))).cast("int"))
    long_run = _sum(F.transform("gamma", lambda g, h: F.when(h == 0, g).when(h > width, 0.0).otherwise(
        2 * g * (1 - h / (width + 1)))))
    return out.withColumn("kpss", F.when(long_run > MIN_VARIANCE, F.try_divide(F.col("spread"), long_run))).drop("spread")


def durbin_levinson(gamma: Column, max_order: int = MAX_ORDER) -> Column:
    """array of struct(p, phi, v): the autoregression of each order and its error variance."""
    none = F.array().cast("array<double>")
    first = F.struct(F.lit(0).alias("p"), none.alias("phi"), _at(gamma, 0).alias("v"))
    start = F.struct(none.alias("phi"), _at(gamma, 0).alias("v"), F.array(first).alias("fits"))

    def step(s: Column, p: Column) -> Column:
        known = F.reverse(F.slice(gamma, F.lit(2), p - 1))
        left = _at(gamma, p) - _dot(s["phi"], known)
        kappa = F.when(s["v"] > MIN_VARIANCE, F.try_divide(left, s["v"])).otherwise(F.lit(0.0))
        phi = F.concat(F.zip_with(s["phi"], F.reverse(s["phi"]), lambda a, b: a - kappa * b), F.array(kappa))
        v = s["v"] * (1 - kappa * kappa)
        fit = F.struct(p.alias("p"), phi.alias("phi"), v.alias("v"))
        return F.struct(phi.alias("phi"), v.alias("v"), F.concat(s["fits"], F.array(fit)).alias("fits"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max_order)), start, step)["fits"]


def search_orders(train: DataFrame, id_col: str = "result_type", date_col: str = "test_date", value_col: str = "count",
                  calendar: DataFrame | None = None, max_order: int = MAX_ORDER) -> DataFrame:
    """One row per (series, d, regressors, p) of a regular daily series (``fill_daily``):
    n, rank, sigma2 (unbiased), log_likelihood, aicc, kpss, chosen, phi, beta and what a
    forecast goes on from.  aicc is NULL, and the model not eligible, without more days
    than parameters.  A series of fewer than four days has no eligible model."""
    days = _cut(design(train, id_col, date_col, value_col, calendar))
    auto = _cut(autocovariances(days, regress(days), max_order))
    level = auto.where("d = 0 and regressors = 'level'").select(
        "result_type", F.when(F.col("kpss") > KPSS_LEVEL, 1).otherwise(0).alias("use_d"), F.col("kpss").alias("kpss_level"))
    x = (auto.join(level, "result_type").withColumn("fit", F.explode(durbin_levinson(F.col("gamma"), max_order)))
         .select("*", "fit.p", "fit.phi", "fit.v"))
    n, k = F.col("n"), F.col("rank") + F.col("p") + 1
    loglik = -n / 2 * (F.log(F.lit(2 * math.pi) * F.greatest("v", F.lit(MIN_VARIANCE))) + 1)
    enough = (n - k - 1 > 0) & ((F.col("regressors") == "level") | (n >= TWO_WEEKS))
    aicc = -2 * loglik + 2 * k + F.try_divide(2 * k * (k + 1), n - k - 1)
    x = x.select("*", loglik.alias("log_likelihood"), F.when(enough, aicc).alias("aicc"),
                 F.when(n - k + 1 > 0, F.try_divide(F.col("v") * n, n - k + 1)).alias("sigma2"))
    best = F.row_number().over(Window.partitionBy("result_type").orderBy(
        (F.col("d") == F.col("use_d")).desc(), F.round("aicc", 6).asc_nulls_last(), "rank", "p", "regressors"))
    return x.select("result_type", "d", "regressors", "p", "n", "rank", "sigma2", "log_likelihood", "aicc",
                    F.col("kpss_level").alias("kpss"),
                    ((best == 1) & F.col("aicc").isNotNull() & (F.col("d") == F.col("use_d"))).alias("chosen"),
                    "phi", "beta", "last_u", "last_date", "last_value", "last_x")


def _ahead(phi: Column, past: Column, horizon: int) -> Column:
    """The recursion's next ``horizon`` values after ``past`` (newest first)."""
    start = F.struct(past.alias("past"), F.array().cast("array<double>").alias("out"))

    def step(s: Column, _h: Column) -> Column:
        new = F.coalesce(_dot(phi, F.slice(s["past"], F.lit(1), F.size(phi))), F.lit(0.0))
        return F.struct(F.slice(F.concat(F.array(new), s["past"]), F.lit(1), F.size(past)).alias("past"),
                        F.concat(s["out"], F.array(new)).alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"]


def _running(a: Column) -> Column:
    return F.transform(a, lambda _v, i: _sum(F.slice(a, F.lit(1), i + 1)))


def seasonal_forecast(fits: DataFrame, horizon: int = 30, confidence_level: float = 0.95,
                      calendar: DataFrame | None = None) -> DataFrame:
    """Forecasts of the chosen models with prediction intervals, columns as of
    ``forecast.forecast``.  Weekday and holiday effects of the days ahead take part."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(0.5 + confidence_level / 2)
    best = _cut(fits.where("chosen"))
    impulse = F.transform("last_u", lambda _v, i: F.when(i == 0, 1.0).otherwise(0.0))
    psi = F.slice(F.concat(F.array(F.lit(1.0)), _ahead(F.col("phi"), impulse, horizon)), 1, horizon)
    x = best.select("*", _ahead(F.col("phi"), F.col("last_u"), horizon).alias("u"), psi.alias("psi"))
    differenced = F.col("d") == 1
    x = x.select("*", F.when(differenced, _running(F.col("u"))).otherwise(F.col("u")).alias("path"),
                 F.when(differenced, _running(F.col("psi"))).otherwise(F.col("psi")).alias("weight"))
    spread = _running(F.transform("weight", lambda v: v * v))
    x = x.select("*", F.posexplode(F.arrays_zip(F.col("path"), spread.alias("spread"))).alias("h", "z"))
    day = F.date_add("last_date", F.col("h") + 1)
    x = x.withColumn("day", day)
    cal = calendar_of(best, F.col("last_date"), F.date_add("last_date", horizon), calendar)
    x = x.join(cal, x.day == cal.holiday_date, "left").withColumn("x", regressors(F.col("day"), F.col("names")))
    # a differenced model adds up from the last value; its level is the daily drift
    change = F.zip_with("x", "last_x", lambda a, b: a - b)
    drift = F.transform(change, lambda v, i: F.when(i == 0, F.col("h") + 1.0).otherwise(v))
    mean = F.when(differenced, F.col("last_value") + _dot(drift, F.col("beta"))).otherwise(_dot(F.col("x"), F.col("beta")))
    value = mean + F.col("z.path")
    se = F.sqrt(F.col("sigma2") * F.col("z.spread"))
    return x.select(F.col("day").cast("timestamp_ntz").alias("forecast_timestamp"), "result_type",
                    value.alias("forecast_value"), se.alias("standard_error"),
                    F.lit(confidence_level).alias("confidence_level"),
                    (value - F.lit(z) * se).alias("prediction_interval_lower_bound"),
                    (value + F.lit(z) * se).alias("prediction_interval_upper_bound"))


def effects(fits: DataFrame) -> DataFrame:
    """(result_type, regressors, effect_of, effect) of the chosen models: what each
    weekday (against Sunday) and holiday adds to a day."""
    named = F.transform("beta", lambda v, i: F.struct(_at(F.array(*[F.lit(c) for c in COLUMNS]), i).alias("effect_of"), v.alias("effect")))
    return fits.where("chosen").select("result_type", "regressors", F.inline(named)).where("effect_of <> 'level'")


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a few rows per series and day: read by several steps."""
    from inspecta.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
