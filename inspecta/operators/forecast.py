"""Daily count series: training set, gap fill, cleaning, holidays, forecasts.

The warehouse forecaster is re-expressed as Spark aggregates and windows over
all series at once.  A window holds one daily series, so its size is bounded by
the training span in days (``years`` x 366), not by the data volume.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inspecta.functions.calendar import gb_holidays
from inspecta.functions.columns import as_of_col
from inspecta.operators.counts import around
from inspecta.schema import ACTUAL_SUFFIX, FORECAST_SUFFIX


# ---- training set (A3-A5, J5, J6) -------------------------------------------
def complete_dates(counts: DataFrame, n_types: int = 2, date_col: str = "test_date",
                   type_col: str = "result_type") -> DataFrame:
    """Timestamps at which all ``n_types`` result types occur."""
    return (counts.groupBy(date_col)
            .agg(F.countDistinct(type_col).alias("n_types"))
            .where(F.col("n_types") == n_types).select(date_col))


def training_cutoff(counts: DataFrame, n_types: int = 2, date_col: str = "test_date") -> DataFrame:
    """One row: the day of the latest complete timestamp (NULL if none)."""
    return (complete_dates(counts, n_types, date_col)
            .agg(F.to_date(F.max(date_col)).alias("cutoff")))


def forecast_training(counts: DataFrame, as_of=None, years: int = 3, n_types: int = 2) -> DataFrame:
    """Daily sums per series between as_of - years and the cutoff (inclusive).

    The cutoff is a scalar subquery; a NULL cutoff gives an empty set.
    """
    cutoff = training_cutoff(counts, n_types).scalar()
    day = F.to_date("test_date")
    return (counts.where((day >= F.add_months(as_of_col(as_of), -12 * years)) & (day <= cutoff))
            .groupBy(day.alias("test_date"), "result_type")
            .agg(F.sum("count").cast("bigint").alias("count")))


# ---- regular grid and cleaning (FC2, FC3) ------------------------------------
def fill_daily(df: DataFrame, id_col: str = "result_type", date_col: str = "test_date",
               value_col: str = "count") -> DataFrame:
    """One row per day between each series' first and last day.

    Input has one row per series and day (e.g. ``forecast_training``).
    Missing days are interpolated linearly between the neighbouring
    observed days; ``filled`` marks them.  Values become double.
    """
    span = df.groupBy(id_col).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    grid = span.select(id_col, F.explode(F.sequence("_lo", "_hi")).alias(date_col))
    j = grid.join(df.select(id_col, date_col, F.col(value_col).cast("double").alias("_y")),
                  [id_col, date_col], "left")
    w = Window.partitionBy(id_col).orderBy(date_col)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    obs_day = F.when(F.col("_y").isNotNull(), F.col(date_col))
    j = j.select("*",
                 F.last("_y", ignorenulls=True).over(before).alias("_y0"),
                 F.last(obs_day, ignorenulls=True).over(before).alias("_d0"),
                 F.first("_y", ignorenulls=True).over(after).alias("_y1"),
                 F.first(obs_day, ignorenulls=True).over(after).alias("_d1"))
    # observed days have _d0 == _d1; try_divide keeps ANSI from raising there
    frac = F.try_divide(F.datediff(date_col, "_d0").cast("double"), F.datediff("_d1", "_d0").cast("double"))
    value = F.coalesce(F.col("_y"), F.col("_y0") + (F.col("_y1") - F.col("_y0")) * frac)
    return j.select(id_col, date_col, value.alias(value_col), F.col("_y").isNull().alias("filled"))


def _median(arr):
    s = F.sort_array(arr)
    n = F.size(s)
    lo = F.element_at(s, F.floor((n + 1) / 2).cast("int"))
    hi = F.element_at(s, F.floor(n / 2 + 1).cast("int"))
    return (lo + hi) / 2


MIN_VARIANCE = 1e-12   # keeps the likelihood of a series without noise finite
MAD_TO_SIGMA = 1.4826  # normal-consistent scale of the median absolute deviation


def clean_spikes(df: DataFrame, id_col: str = "result_type", date_col: str = "test_date",
                 value_col: str = "count", half_window: int = 3, k: float = 3.0,
                 min_scale: float = 1.0) -> DataFrame:
    """Replace spikes and dips by the rolling median (Hampel filter).

    A value is a spike when it is more than ``k`` robust standard deviations
    (1.4826 x rolling median absolute deviation, at least ``min_scale``)
    from the rolling median of the centred window of ``2*half_window+1``
    rows.  The floor keeps flat stretches (MAD 0) from flagging unit noise.
    Expects a regular (filled) series.
    """
    w = (Window.partitionBy(id_col).orderBy(date_col)
         .rowsBetween(-half_window, half_window))
    win = F.collect_list(F.col(value_col).cast("double")).over(w)
    x = df.select("*", win.alias("_win"))
    x = x.withColumn("_med", _median(F.col("_win")))
    x = x.withColumn("_mad", _median(F.transform("_win", lambda v: F.abs(v - F.col("_med")))))
    scale = F.greatest(F.lit(MAD_TO_SIGMA) * F.col("_mad"), F.lit(float(min_scale)))
    spike = F.abs(F.col(value_col) - F.col("_med")) > F.lit(float(k)) * scale
    return x.select(
        *[c for c in df.columns if c != value_col],
        F.when(spike, F.col("_med")).otherwise(F.col(value_col).cast("double")).alias(value_col),
        spike.alias("is_spike"))


def clean_seasonal_spikes(df: DataFrame, id_col: str = "result_type", date_col: str = "test_date",
                          value_col: str = "count", weeks: int = 2, half_window: int = 7, k: float = 3.0,
                          min_scale: float = 1.0) -> DataFrame:
    """Replace spikes and dips by what the weekday usually has.

    The weekly component of a day, trend included, is the median of the same weekday from
    ``weeks`` before to ``weeks`` after it.  What is left over is tested like in
    ``clean_spikes``: a spike is more than ``k`` robust standard deviations of the
    ``2*half_window+1`` days around it (at least ``min_scale``) off.  Regular weekend
    dips have nothing left over and stay.  Expects a regular (filled) series.
    """
    same = (Window.partitionBy(id_col, F.dayofweek(date_col)).orderBy(date_col).rowsBetween(-weeks, weeks))
    near = Window.partitionBy(id_col).orderBy(date_col).rowsBetween(-half_window, half_window)
    value = F.col(value_col).cast("double")
    x = df.select("*", _median(F.collect_list(value).over(same)).alias("_base"))
    x = x.select("*", F.collect_list(F.abs(value - F.col("_base"))).over(near).alias("_left"))
    scale = F.greatest(F.lit(MAD_TO_SIGMA) * _median(F.col("_left")), F.lit(float(min_scale)))
    spike = F.abs(value - F.col("_base")) > F.lit(float(k)) * scale
    return x.select(*[c for c in df.columns if c != value_col],
                    F.when(spike, F.col("_base")).otherwise(value).alias(value_col), spike.alias("is_spike"))


# ---- holidays (FC4, J8) -------------------------------------------------------
def with_holidays(df: DataFrame, date_col: str = "test_date", calendar: DataFrame | None = None,
                  horizon: int = 0) -> DataFrame:
    """Left join of a holiday calendar on the day.

    Without a ``calendar`` the rule-based one is made for the years from the
    series' first day to its last plus ``horizon`` days, and broadcast: 8 rows a
    year.  A given calendar is joined without a hint."""
    if calendar is None:
        lo, hi = df.agg(F.year(F.min(F.to_date(date_col))),
                        F.year(F.date_add(F.max(F.to_date(date_col)), horizon))).first()
        # a holiday of the next year may be observed in this one
        calendar = F.broadcast(gb_holidays(df.sparkSession, (lo or 1) - 1, (hi or 1) + 1))
    cal = calendar.select("holiday_date", "holiday_name")
    return df.join(cal, F.to_date(df[date_col]) == cal.holiday_date, "left").drop("holiday_date")


def holiday_effect(df: DataFrame, id_col: str = "result_type", value_col: str = "count") -> DataFrame:
    """Mean difference between holiday days and the series mean, per holiday."""
    w = Window.partitionBy(id_col)
    x = df.withColumn("_mean", F.avg(value_col).over(w))
    return (x.where(F.col("holiday_name").isNotNull())
            .groupBy(id_col, "holiday_name")
            .agg(F.avg(F.col(value_col) - F.col("_mean")).alias("effect"),
                 F.count(F.lit(1)).alias("days")))


# ---- closed-form AR(1) baseline (FC5 SQL form) --------------------------------
def ar1_baseline(train: DataFrame, id_col: str = "result_type", date_col: str = "test_date",
                 value_col: str = "count") -> DataFrame:
    """y_t = c + phi * y_{t-1} by least squares per series, plus the last point.

    Expects a regular (filled) series: the previous row is the previous day."""
    w = Window.partitionBy(id_col).orderBy(date_col)
    y = F.col(value_col).cast("double")
    x = train.select(id_col, date_col, y.alias("_y"), F.lag(y).over(w).alias("_lag"))
    return x.groupBy(id_col).agg(
        F.regr_slope("_y", "_lag").alias("phi"),
        F.regr_intercept("_y", "_lag").alias("c"),
        F.max_by("_y", date_col).alias("last_value"),
        F.max(date_col).alias("last_date"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def ar1_forecast(params: DataFrame, horizon: int = 30, id_col: str = "result_type") -> DataFrame:
    """h-step forecasts of the AR(1) baseline for h = 1..horizon."""
    h = F.col("h")
    phi_h = F.pow(F.col("phi"), h)
    mean_part = F.when(F.col("phi") == 1.0, F.col("c") * h).otherwise(
        F.col("c") * (1 - phi_h) / (1 - F.col("phi")))
    return (params.select(id_col, "phi", "c", "last_value", "last_date",
                          F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
            .select(F.date_add("last_date", h).cast("timestamp_ntz").alias("forecast_timestamp"),
                    id_col, (mean_part + phi_h * F.col("last_value")).alias("forecast_value")))


# ---- blend (U1, P12) -----------------------------------------------------------
def prediction_output(counts: DataFrame, forecast: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Actuals before as_of and forecasts from as_of, within +/- days.

    Actual rows are not re-aggregated (one per timestamp for a timestamp
    grained count table).  Counts are double; forecasts are floored at 0
    and stay NULL when the forecast is NULL.
    """
    d = as_of_col(as_of)
    actual = (counts.where(F.to_date("test_date") < d)
              .select(F.to_date("test_date").alias("test_date"),
                      F.concat("result_type", F.lit(ACTUAL_SUFFIX)).alias("chart_series"),
                      F.col("count").cast("double").alias("count")))
    v = F.col("forecast_value")
    fc = (forecast.where(F.to_date("forecast_timestamp") >= d)
          .select(F.to_date("forecast_timestamp").alias("test_date"),
                  F.concat("result_type", F.lit(FORECAST_SUFFIX)).alias("chart_series"),
                  F.when(v.isNotNull(), F.greatest(v, F.lit(0.0))).alias("count")))
    return around(actual.unionByName(fc), "test_date", days, as_of)


# ---- candidate models, choice and forecast (FC5-FC7) ------------------------------
def fit_forecast(train: DataFrame, id_col: str = "result_type", date_col: str = "test_date",
                 value_col: str = "count") -> DataFrame:
    """Three closed-form models per series, all by Spark aggregates over the days.

    * ``ar1``      y_t = c + phi * y_{t-1} by least squares
    * ``drift``    y_t = y_{t-1} + mean step
    * ``weekday``  y_t = mean of its weekday

    Input is a regular daily series (``fill_daily`` / ``clean_spikes``).  All are
    measured on the days that have a day before them, so their AIC compares.
    One row per (series, model): n (those days), sigma2, log_likelihood, aicc,
    chosen (lowest corrected AIC, then model name), the parameters phi, c and weekdays
    (weekday -> mean; 1 is Sunday), last_value and last_date.  A model needs more
    days than it has parameters, and weekday means need two weeks; without them
    (or for ar1 without variance) aicc is NULL and the model can't be chosen.  A
    series with no fitting model has no forecast.
    """
    from inspecta.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(train.sparkSession)
    w = Window.partitionBy(id_col).orderBy(date_col)
    y = F.col(value_col).cast("double")
    # a few rows a day and series, read by three aggregates: cut once
    x = train.select(F.col(id_col).alias("result_type"), F.col(date_col).alias("test_date"), y.alias("y"),
                     F.lag(y).over(w).alias("y0"), F.dayofweek(date_col).alias("wd")).checkpoint(eager=True)
    means = x.groupBy("result_type", "wd").agg(F.avg("y").alias("m"))
    week = means.groupBy("result_type").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("wd", "m")))).alias("weekdays"))
    base = x.groupBy("result_type").agg(
        F.regr_slope("y", "y0").alias("phi"), F.regr_intercept("y", "y0").alias("c"),
        F.avg(F.col("y") - F.col("y0")).alias("step"), F.count("y0").alias("n"),
        F.max_by("y", "test_date").alias("last_value"), F.max("test_date").alias("last_date"))
    params = base.join(week, "result_type")     # one row per series on both sides
    e = x.where("y0 is not null").join(params, "result_type").withColumn("fitted", F.array(
        F.struct(F.lit("ar1").alias("model"), F.lit(2).alias("k"), (F.col("c") + F.col("phi") * F.col("y0")).alias("v")),
        F.struct(F.lit("drift").alias("model"), F.lit(1).alias("k"), (F.col("y0") + F.col("step")).alias("v")),
        F.struct(F.lit("weekday").alias("model"), F.lit(7).alias("k"), F.element_at("weekdays", F.col("wd")).alias("v"))))
    sq = (e.withColumn("f", F.explode("fitted")).groupBy("result_type", "f.model", "f.k")
          .agg(F.avg((F.col("y") - F.col("f.v")) * (F.col("y") - F.col("f.v"))).alias("sigma2")))
    s2 = F.greatest(F.col("sigma2"), F.lit(MIN_VARIANCE))
    loglik = -F.col("n") / 2 * (F.log(F.lit(2 * math.pi) * s2) + 1)
    k = F.col("k") + 1          # the variance too
    left = F.col("n") - k - 1
    fits = (sq.join(params, "result_type").withColumn("log_likelihood", F.when(F.col("sigma2").isNotNull(), loglik))
            .withColumn("aicc", F.when((left > 0) & ((F.col("model") != "weekday") | (F.col("n") >= 14)),
                                       2 * k - 2 * F.col("log_likelihood") + F.try_divide(2 * k * (k + 1), left))))
    best = F.row_number().over(Window.partitionBy("result_type").orderBy(F.col("aicc").asc_nulls_last(), "model"))
    return fits.select(
        "result_type", "model", "n", "sigma2", "log_likelihood", "aicc",
        ((best == 1) & F.col("aicc").isNotNull()).alias("chosen"),
        F.when(F.col("model") == "ar1", F.col("phi")).when(F.col("model") == "drift", F.lit(1.0)).alias("phi"),
        F.when(F.col("model") == "ar1", F.col("c")).when(F.col("model") == "drift", F.col("step")).alias("c"),
        F.when(F.col("model") == "weekday", F.col("weekdays")).alias("weekdays"), "last_value", "last_date")


def forecast(fits: DataFrame, horizon: int = 30, confidence_level: float = 0.95) -> DataFrame:
    """Forecasts of the chosen model per series with prediction intervals.

    (forecast_timestamp, result_type, forecast_value, standard_error,
    confidence_level, prediction_interval_lower_bound, ..._upper_bound).
    ``drift`` is the recursion with phi = 1.
    """
    from statistics import NormalDist
    z = NormalDist().inv_cdf(0.5 + confidence_level / 2)
    x = fits.where("chosen").withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    day = F.date_add("last_date", F.col("h"))
    phi, h = F.col("phi"), F.col("h")
    phi_h = F.pow(phi, h)
    unit = F.abs(phi) == 1.0
    path = F.when(phi == 1.0, F.col("c") * h).otherwise(F.col("c") * (1 - phi_h) / (1 - phi)) + phi_h * F.col("last_value")
    value = F.when(F.col("weekdays").isNotNull(), F.element_at("weekdays", F.dayofweek(day))).otherwise(path)
    spread = F.when(F.col("weekdays").isNotNull(), F.lit(1.0)).when(unit, h.cast("double")).otherwise(
        (1 - F.pow(phi, 2 * h)) / (1 - phi * phi))
    se = F.sqrt(F.col("sigma2") * spread)
    return x.select(day.cast("timestamp_ntz").alias("forecast_timestamp"), "result_type",
                    value.alias("forecast_value"), se.alias("standard_error"),
                    F.lit(confidence_level).alias("confidence_level"),
                    (value - F.lit(z) * se).alias("prediction_interval_lower_bound"),
                    (value + F.lit(z) * se).alias("prediction_interval_upper_bound"))


def evaluate_forecast(fits: DataFrame) -> DataFrame:
    """One row per (series, model): days, variance, log-likelihood, corrected AIC and
    whether the model was chosen."""
    return fits.select("result_type", "model", "n", "sigma2", "log_likelihood", "aicc", "chosen")
