"""Per-vehicle derived columns (last test, mileage, age, pass/fail counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.functions.columns import (
    count_results, last_test, to_mileage, vehicle_age,
)
from inspecta.schema import FAILED, NEVER_MOT, PASSED


def _odometer_type(df: DataFrame | None, tests: str):
    """Declared type of motTests[].odometerValue (numbers round, text is parsed)."""
    if df is None:
        return None
    try:
        return df.schema[tests].dataType.elementType["odometerValue"].dataType
    except (KeyError, AttributeError):
        return None


def derived_columns(as_of=None, on_bad: str = "error", tests: str = "motTests",
                    first_used: str = "firstUsedDate", df: DataFrame | None = None) -> dict:
    last = last_test(tests)
    return {
        "last_test_date": last.getField("completedDate"),
        "last_test_result": F.coalesce(last.getField("testResult"), F.lit(NEVER_MOT)),
        "mileage": to_mileage(last.getField("odometerValue"), on_bad, _odometer_type(df, tests)),
        "vehicle_age": vehicle_age(first_used, as_of),
        "pass_count": count_results(tests, PASSED),
        "fail_count": count_results(tests, FAILED),
    }


def enrich(df: DataFrame, as_of=None, on_bad: str = "error") -> DataFrame:
    """Add the six derived columns to every vehicle record.

    A single projection over the nested test list: no shuffle, row count
    unchanged, existing derived columns are replaced.  ``on_bad`` chooses
    what an odometer text that is not an integer does: raise or NULL.
    """
    return df.withColumns(derived_columns(as_of, on_bad, df=df))


def enrich_flat(vehicles: DataFrame, tests: DataFrame, as_of=None, on_bad: str = "error",
                key: str = "registration") -> DataFrame:
    """Same derived columns from a flat test log (one row per test).

    For logs where one vehicle may own a large share of all tests: every
    aggregate here is partial (map-side combine), so a hot key is reduced
    to one row per map task before the shuffle.  The last test is the one
    with the greatest (completedDate, motTestNumber), which is the last
    position of the date-ordered list.
    """
    per = (tests.groupBy(key)
           .agg(F.max_by(F.struct("completedDate", "testResult", "odometerValue"),
                         F.struct("completedDate", "motTestNumber")).alias("_last"),
                F.count_if(F.col("testResult") == PASSED).cast("bigint").alias("pass_count"),
                F.count_if(F.col("testResult") == FAILED).cast("bigint").alias("fail_count")))
    out = vehicles.join(per, key, "left")
    return out.select(
        *[c for c in vehicles.columns],
        F.col("_last.completedDate").alias("last_test_date"),
        F.coalesce(F.col("_last.testResult"), F.lit(NEVER_MOT)).alias("last_test_result"),
        to_mileage(F.col("_last.odometerValue"), on_bad, tests.schema["odometerValue"].dataType).alias("mileage"),
        vehicle_age("firstUsedDate", as_of).alias("vehicle_age"),
        F.coalesce("pass_count", F.lit(0)).cast("bigint").alias("pass_count"),
        F.coalesce("fail_count", F.lit(0)).cast("bigint").alias("fail_count"),
    )
