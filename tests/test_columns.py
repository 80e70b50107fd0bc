import datetime as dt

import pytest

from inspecta.functions.columns import (
    count_results, feed_date_from_path, feed_date_string, last_test_result, to_mileage,
    vehicle_age, pass_probability, last_test_date,
)
from inspecta.operators.enrich import enrich
from inspecta.schema import VEHICLE, MOT_TEST

TS = dt.datetime


def _vehicles(spark, rows):
    base = {f: None for f in VEHICLE.fieldNames()}
    data = [{**base, **r} for r in rows]
    return spark.createDataFrame(data, VEHICLE)


def _t(day, result, odo, n=1):
    return (TS(2020, 1, day), n, result, odo)


def test_last_test_and_counts_edge_cases(spark):
    df = _vehicles(spark, [
        {"registration": "none"},                       # no motTests key
        {"registration": "empty", "motTests": []},
        {"registration": "nullres", "motTests": [_t(1, "PASSED", "10"), _t(2, None, "20", 2)]},
        {"registration": "two", "motTests": [_t(3, "FAILED", "5"), _t(1, "PASSED", "7", 2)]},
        {"registration": "other", "motTests": [_t(1, "ABANDONED", "9")]},
    ])
    out = {r.registration: r for r in enrich(df, dt.date(2021, 1, 1)).collect()}
    assert out["none"].last_test_result == "NEVER MOT" and out["none"].last_test_date is None
    assert out["none"].pass_count == 0 and out["none"].fail_count == 0
    assert out["empty"].last_test_result == "NEVER MOT" and out["empty"].mileage is None
    assert out["nullres"].last_test_result == "NEVER MOT"   # NULL result of a real test
    assert out["nullres"].mileage == 20 and out["nullres"].pass_count == 1
    # last array position, not the latest date
    assert out["two"].last_test_result == "PASSED" and out["two"].last_test_date == TS(2020, 1, 1)
    assert (out["two"].pass_count, out["two"].fail_count) == (1, 1)
    assert (out["other"].pass_count, out["other"].fail_count) == (0, 0)
    assert out["other"].last_test_result == "ABANDONED"


def test_mileage_text_and_numbers(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("abc",), ("12.5",), (None,), ("99999999999999999999",)], "v string")
    got = [r[0] for r in df.select(to_mileage("v", on_bad="null")).collect()]
    assert got == [12, 7, None, None, None, None]
    with pytest.raises(Exception):
        spark.createDataFrame([("abc",)], "v string").select(to_mileage("v")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("12.5",)], "v string").select(to_mileage("v")).collect()
    ok = spark.createDataFrame([("12",), (None,)], "v string").select(to_mileage("v")).collect()
    assert [r[0] for r in ok] == [12, None]
    num = spark.createDataFrame([(12.5,), (-12.5,), (12.4,)], "v double")
    from pyspark.sql import types as T
    got = [r[0] for r in num.select(to_mileage("v", source_type=T.DoubleType())).collect()]
    assert got == [13, -13, 12]   # half away from zero


def test_vehicle_age_counts_year_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2020, 1, 1),), (None,)], "d date")
    got = [r[0] for r in df.select(vehicle_age("d", dt.date(2026, 1, 1))).collect()]
    assert got == [1, 6, None]


def test_count_results_null_array(spark):
    df = spark.createDataFrame([(None,)], f"t array<{MOT_TEST.simpleString()}>")
    assert df.select(count_results("t", "PASSED")).first()[0] == 0
    assert df.select(last_test_result("t")).first()[0] == "NEVER MOT"
    assert df.select(last_test_date("t")).first()[0] is None


def test_feed_date_from_path(spark):
    df = spark.createDataFrame([
        ("/data/delta-light-vehicle_02-02-2026/part-0.json.gz",),
        ("/data/delta-light-vehicle_01-03-2024/x.json.gz",),
        ("/data/bulk-light-vehicle/part-0.json.gz",),
        ("/data/delta-light-vehicle_31-02-2026/part-0.json.gz",),
    ], "p string")
    rows = df.select(feed_date_from_path("p").alias("d")).select("d", feed_date_string("d")).collect()
    assert rows[0][0] == dt.date(2026, 2, 1) and rows[0][1] == "01-02-2026"
    assert rows[1][0] == dt.date(2024, 2, 29)       # leap day
    assert rows[2][0] is None and rows[2][1] == ""
    assert rows[3][0] is None                        # not a calendar date


def test_pass_probability(spark):
    df = spark.createDataFrame([([("FAILED", 0.3), ("PASSED", 0.7)],), ([("FAILED", 1.0)],), (None,)],
                               "p array<struct<label:string,prob:double>>")
    got = [r[0] for r in df.select(pass_probability("p")).collect()]
    assert got == [0.7, None, None]


def test_numeric_odometer_rounds(spark):
    from pyspark.sql import types as T
    test = T.StructType([T.StructField("completedDate", T.TimestampNTZType()),
                         T.StructField("testResult", T.StringType()),
                         T.StructField("odometerValue", T.DoubleType())])
    schema = T.StructType([T.StructField("registration", T.StringType()),
                           T.StructField("firstUsedDate", T.DateType()),
                           T.StructField("motTests", T.ArrayType(test))])
    df = spark.createDataFrame([("n", None, [(TS(2020, 1, 1), "PASSED", 12.5)])], schema)
    assert enrich(df, dt.date(2021, 1, 1)).first().mileage == 13
