"""Public-holiday calendar generated by rule inside Spark.

England & Wales bank holidays: New Year's Day, Good Friday, Easter Monday,
early May, spring and summer bank holidays, Christmas and Boxing Day, with
weekend substitutes.  One-off proclamations (jubilees, moved May days) are
not rule-based and are not included.  Easter uses the anonymous Gregorian
computus (Meeus/Jones/Butcher).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _easter_sunday(y):
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    n = h + l_ - 7 * m + 114
    return F.make_date(y, F.floor(n / 31).cast("int"), (n % 31 + 1).cast("int"))


def _weekend_to_monday(d):
    dow = F.dayofweek(d)  # 1 = Sunday, 7 = Saturday
    return F.when(dow == 7, F.date_add(d, 2)).when(dow == 1, F.date_add(d, 1)).otherwise(d)


def _weekend_plus_two(d):
    dow = F.dayofweek(d)
    return F.when((dow == 7) | (dow == 1), F.date_add(d, 2)).otherwise(d)


def gb_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(holiday_date date, holiday_name string, region string) for the years.

    Size is 8 rows per year, so it is safe to broadcast.
    """
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    y = F.col("y")
    easter = _easter_sunday(y)
    named = [
        ("NewYear", _weekend_to_monday(F.make_date(y, F.lit(1), F.lit(1)))),
        ("GoodFriday", F.date_sub(easter, 2)),
        ("EasterMonday", F.date_add(easter, 1)),
        ("EarlyMayBankHoliday", F.next_day(F.make_date(y, F.lit(4), F.lit(30)), "Mon")),
        ("SpringBankHoliday", F.next_day(F.make_date(y, F.lit(5), F.lit(24)), "Mon")),
        ("SummerBankHoliday", F.next_day(F.make_date(y, F.lit(8), F.lit(24)), "Mon")),
        ("Christmas", _weekend_plus_two(F.make_date(y, F.lit(12), F.lit(25)))),
        ("BoxingDay", _weekend_plus_two(F.make_date(y, F.lit(12), F.lit(26)))),
    ]
    rows = F.array(*[F.struct(d.alias("holiday_date"), F.lit(n).alias("holiday_name")) for n, d in named])
    return (years.select(F.inline(rows))
            .withColumn("region", F.lit("GB")))
