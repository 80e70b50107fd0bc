"""Declared schemas of the vehicle feed and the derived tables."""

from pyspark.sql import types as T

# Fixed values that must equal the reference's for right results:
# result labels, merge actions, default label, feed folder prefixes,
# feed date format, the flat-export column order and the merged columns.
PASSED = "PASSED"
FAILED = "FAILED"
NEVER_MOT = "NEVER MOT"
CREATED = "CREATED"
UPDATED = "UPDATED"
DELETED = "DELETED"
MODIFICATIONS = (CREATED, UPDATED, DELETED)
DELTA_PREFIX = "delta-light-vehicle"
BULK_PREFIX = "bulk-light-vehicle"
FEED_DATE_FORMAT = "dd-MM-yyyy"
ACTUAL_SUFFIX = " - ACTUAL"
FORECAST_SUFFIX = " - FORECAST"
FLAT_COLUMNS = [
    "date", "registration", "make", "model", "primaryColour",
    "secondaryColour", "fuelType", "engineSize", "manufactureDate",
    "registrationDate", "firstUsedDate", "lastMotTestDate", "modification",
    "motTestCount", "motTests",
]

# Columns a MERGE update / insert sets (everything else on a matched row
# keeps main's value; on an inserted row it is NULL).
MERGE_SET_COLUMNS = [
    "modification", "motTests", "engineSize", "make", "model",
    "lastMotTestDate", "manufactureDate", "primaryColour",
    "registrationDate", "fuelType", "secondaryColour", "firstUsedDate",
    "last_test_date", "last_test_result", "mileage", "vehicle_age",
    "pass_count", "fail_count",
]

# Timestamps are wall-clock values (no zone), like the warehouse TIMESTAMP
# read back in UTC.  timestamp_ntz keeps them stable under any session zone.
TS = T.TimestampNTZType()

MOT_TEST = T.StructType([
    T.StructField("completedDate", TS),
    T.StructField("motTestNumber", T.LongType()),
    T.StructField("testResult", T.StringType()),
    T.StructField("odometerValue", T.StringType()),
])

VEHICLE = T.StructType([
    T.StructField("registration", T.StringType()),
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("primaryColour", T.StringType()),
    T.StructField("secondaryColour", T.StringType()),
    T.StructField("fuelType", T.StringType()),
    T.StructField("engineSize", T.StringType()),
    T.StructField("manufactureDate", T.DateType()),
    T.StructField("registrationDate", T.DateType()),
    T.StructField("firstUsedDate", T.DateType()),
    T.StructField("lastMotTestDate", TS),
    T.StructField("modification", T.StringType()),
    T.StructField("motTests", T.ArrayType(MOT_TEST)),
])

DERIVED = T.StructType([
    T.StructField("last_test_date", TS),
    T.StructField("last_test_result", T.StringType()),
    T.StructField("mileage", T.LongType()),
    T.StructField("vehicle_age", T.LongType()),
    T.StructField("pass_count", T.LongType()),
    T.StructField("fail_count", T.LongType()),
])

DAILY_COUNTS = "test_date timestamp_ntz, result_type string, count bigint"
FORECAST_OUT = "forecast_timestamp timestamp_ntz, result_type string, forecast_value double"

# fixed values: names of the calendar's holidays (functions/calendar.py)
HOLIDAYS = ("NewYear", "GoodFriday", "EasterMonday", "EarlyMayBankHoliday", "SpringBankHoliday", "SummerBankHoliday",
            "Christmas", "BoxingDay")
