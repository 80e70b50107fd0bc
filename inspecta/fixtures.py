"""Vehicle-shaped inputs derived from the supplied test tables.

The test data is a TPC-H-like star schema plus an ``events`` table; these
functions map it onto the vehicle feed so every operator runs on data that
grows with the tables.  Each mapping is a Spark job over the whole table.

F1 history   customer (+ nation, region) with its orders as the test list, and
             supplier as vehicles that were never tested
F2 delta     events as change records against the F1 main table; some name
             vehicles that main doesn't have
F3 series    orders per day per status as daily count series
F4 feed      F1/F2 written as gz NDJSON feed folders (see sources.feed)
F5 alerts    events as base64 budget envelopes
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inspecta.schema import CREATED, DELETED, FAILED, PASSED, UPDATED, VEHICLE

# Fixed run dates of the fixtures (CURRENT_DATE would make results drift).
AS_OF_HISTORY = _dt.date(2001, 8, 1)
AS_OF_DELTA = _dt.date(2024, 1, 31)
BULK_FEED_DATE = _dt.date(2026, 3, 13)
ABANDONED = "ABANDONED"
UNTESTED_PREFIX = "S"     # vehicles without tests
NEW_PREFIX = "N"          # vehicles that only the delta has


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Frames that ``materialise`` has written: (sf_dir, name) -> path.
_WRITTEN: dict[tuple[str, str], str] = {}


def _stored_or(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    path = _WRITTEN.get((sf_dir.rstrip("/"), name))
    return spark.read.parquet(path) if path else build()


def materialise(spark: SparkSession, sf_dir: str) -> None:
    """Write the derived inputs once; later calls on ``sf_dir`` read them.  Used by
    the bench, so that it times operators and not the mapping of the test tables."""
    from inspecta.session import scratch_dir
    for name, build in (("history", history), ("tests_flat", tests_flat), ("delta", delta),
                        ("main_table", main_table), ("budget_envelopes", budget_envelopes)):
        path = scratch_dir(spark, f"fixture-{name}")
        build(spark, sf_dir).write.parquet(path)
        _WRITTEN[sf_dir.rstrip("/"), name] = path
    root = scratch_dir(spark, "fixture-feed")
    _WRITTEN[sf_dir.rstrip("/"), "feed"] = write_feed_fixture(spark, sf_dir, root)


def status_result(status: Column) -> Column:
    return (F.when(status == "F", F.lit(PASSED))
            .when(status == "O", F.lit(FAILED))
            .when(status == "P", F.lit(ABANDONED)))


def tests_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per test: every order."""
    return _stored_or(spark, sf_dir, "tests_flat", lambda: _tests_flat(spark, sf_dir))


def _tests_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.select(F.col("o_custkey").cast("string").alias("registration"),
                    F.col("o_orderdate").alias("completedDate"),
                    F.col("o_orderkey").alias("motTestNumber"),
                    status_result(F.col("o_orderstatus")).alias("testResult"),
                    F.floor("o_totalprice").cast("string").alias("odometerValue")))


def _vehicle_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle attributes: customers by their bigint key, then suppliers, whose
    ``_key`` is NULL, so that no order is theirs."""
    c = table(spark, sf_dir, "customer")
    u = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation / region are fixed 25 / 5 row dimensions: broadcasting them is bounded.
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                      .select("n_nationkey", "n_name", "r_name"))
    owners = c.select(F.col("c_custkey").alias("_key"), F.col("c_custkey").cast("string").alias("registration"),
                      F.col("c_mktsegment").alias("make"), F.col("c_nationkey").alias("_nation"),
                      F.col("c_acctbal").alias("_balance")).unionByName(
        u.select(F.lit(None).cast("bigint").alias("_key"),
                 F.concat(F.lit(UNTESTED_PREFIX), F.col("s_suppkey").cast("string")).alias("registration"),
                 F.lit("BUILDING").alias("make"), F.col("s_nationkey").alias("_nation"),
                 F.col("s_acctbal").alias("_balance")))
    return (owners.join(geo, owners._nation == geo.n_nationkey, "left")
            .select("_key", "registration", "make",
                    F.col("n_name").alias("model"),
                    F.lower("r_name").alias("primaryColour"),
                    F.lit("Not Stated").alias("secondaryColour"),
                    F.when(F.col("_balance") >= 0, "PETROL").otherwise("DIESEL").alias("fuelType"),
                    (F.col("_nation") * 100 + 1000).cast("string").alias("engineSize")))


def vehicles_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle attributes without the test list (one row per vehicle)."""
    return _vehicle_attrs(spark, sf_dir).drop("_key")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one nested vehicle record per customer and supplier (VEHICLE schema + date tags).

    Tests are pre-aggregated per vehicle (on the integer key) before the
    join; a vehicle's list is what the feed itself carries per record.
    """
    return _stored_or(spark, sf_dir, "history", lambda: _history(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    test = F.struct(F.col("o_orderdate").alias("completedDate"),
                    F.col("o_orderkey").alias("motTestNumber"),
                    status_result(F.col("o_orderstatus")).alias("testResult"),
                    F.floor("o_totalprice").cast("string").alias("odometerValue"))
    per_vehicle = (o.groupBy(F.col("o_custkey").alias("_key"))
                   .agg(F.sort_array(F.collect_list(test)).alias("motTests")))
    v = _vehicle_attrs(spark, sf_dir).join(per_vehicle, "_key", "left")
    first_day = F.to_date(F.try_element_at("motTests", F.lit(1)).getField("completedDate"))
    out = v.select(
        "registration", "make", "model", "primaryColour", "secondaryColour", "fuelType", "engineSize",
        first_day.alias("manufactureDate"), first_day.alias("registrationDate"),
        first_day.alias("firstUsedDate"),
        F.try_element_at("motTests", F.lit(-1)).getField("completedDate").alias("lastMotTestDate"),
        F.lit(CREATED).alias("modification"),
        F.coalesce("motTests", F.array().cast(VEHICLE["motTests"].dataType)).alias("motTests"),
        F.lit(BULK_FEED_DATE.strftime("%d-%m-%Y")).alias("date"),
        F.lit(BULK_FEED_DATE).alias("feed_date"),
    )
    return out


def modification_of(event_id: Column) -> Column:
    m = event_id % 10
    return (F.when(m.isin(0, 3, 7), F.lit(DELETED))
            .when(m == 1, F.lit(CREATED))
            .when(m == 9, F.lit("NOISE"))
            .otherwise(F.lit(UPDATED)))


def delta_registration(user_id: Column, event_id: Column) -> Column:
    """The vehicle of an event: its user's, or one that main doesn't have (half of the
    CREATED events, and half of one kind of DELETED ones)."""
    new = (event_id % 20).isin(11, 17)
    return F.when(new, F.concat(F.lit(NEW_PREFIX), user_id.cast("string"))).otherwise(user_id.cast("string"))


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as change records (VEHICLE schema + date tags).

    ``modification`` comes from the event id (0/3/7 DELETED, 1 CREATED,
    9 an unknown value that the merge must filter, else UPDATED).
    """
    return _stored_or(spark, sf_dir, "delta", lambda: _delta(spark, sf_dir))


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    test = F.struct(
        F.col("ts").alias("completedDate"),
        F.col("event_id").alias("motTestNumber"),
        F.when(F.col("event_type") == "purchase", PASSED)
         .when(F.col("event_type") == "error", FAILED)
         .otherwise(ABANDONED).alias("testResult"),
        F.floor("value").cast("string").alias("odometerValue"))
    day = F.to_date("ts")
    return e.select(
        delta_registration(F.col("user_id"), F.col("event_id")).alias("registration"),
        F.upper("event_type").alias("make"),
        F.col("event_type").alias("model"),
        F.lit("silver").alias("primaryColour"),
        F.lit(None).cast("string").alias("secondaryColour"),
        F.lit("ELECTRIC").alias("fuelType"),
        F.lit(None).cast("string").alias("engineSize"),
        day.alias("manufactureDate"), day.alias("registrationDate"), day.alias("firstUsedDate"),
        F.col("ts").alias("lastMotTestDate"),
        modification_of(F.col("event_id")).alias("modification"),
        F.array(test).alias("motTests"),
        F.date_format("ts", "dd-MM-yyyy").alias("date"),
        day.alias("feed_date"),
        F.col("event_id"),
    )


def main_table(spark: SparkSession, sf_dir: str, as_of=AS_OF_DELTA) -> DataFrame:
    """F2 main: all enriched F1 vehicles."""
    if as_of != AS_OF_DELTA:
        return _main_table(spark, sf_dir, as_of)
    return _stored_or(spark, sf_dir, "main_table", lambda: _main_table(spark, sf_dir, as_of))


def _main_table(spark: SparkSession, sf_dir: str, as_of=AS_OF_DELTA) -> DataFrame:
    from inspecta.operators.enrich import enrich
    return enrich(history(spark, sf_dir), as_of)


def series_counts(spark: SparkSession, sf_dir: str, with_abandoned: bool = False) -> DataFrame:
    """(test_date timestamp, result_type, count) per order day and status."""
    o = table(spark, sf_dir, "orders")
    statuses = ["F", "O", "P"] if with_abandoned else ["F", "O"]
    return (o.where(F.col("o_orderstatus").isin(statuses))
            .groupBy(F.col("o_orderdate").alias("test_date"),
                     status_result(F.col("o_orderstatus")).alias("result_type"))
            .agg(F.count(F.lit(1)).alias("count")))


def budget_envelopes(spark: SparkSession, sf_dir: str, budget: float = 50.0) -> DataFrame:
    """one base64 budget message per event (cost = event value)."""
    if budget != 50.0:
        return _budget_envelopes(spark, sf_dir, budget)
    return _stored_or(spark, sf_dir, "budget_envelopes", lambda: _budget_envelopes(spark, sf_dir, budget))


def _budget_envelopes(spark: SparkSession, sf_dir: str, budget: float = 50.0) -> DataFrame:
    e = table(spark, sf_dir, "events")
    body = F.to_json(F.struct(F.col("value").alias("costAmount"),
                              F.lit(float(budget)).alias("budgetAmount")))
    return e.select("event_id", F.base64(F.encode(body, "UTF-8")).alias("data"))


# ---- F4: feed folders ----------------------------------------------------------
BULK_FOLDER = "bulk-light-vehicle_14-03-2026"
DELTA_OLD_FOLDER = "delta-light-vehicle_15-01-2024"
DELTA_NEW_FOLDER = "delta-light-vehicle_31-01-2024"
DELTA_SPLIT = "2024-01-15 00:00:00"


def _split_col():
    return F.lit(DELTA_SPLIT).cast("timestamp_ntz")


def write_feed_fixture(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """Write F1 as a bulk folder and F2 as two delta folders (gz NDJSON)."""
    from inspecta.session import scratch_dir
    from inspecta.sources.feed import write_feed
    written = _WRITTEN.get((sf_dir.rstrip("/"), "feed"))
    if root is None and written:
        return written
    root = root or scratch_dir(spark, "feed")
    fields = VEHICLE.fieldNames()
    write_feed(history(spark, sf_dir).select(*fields), root, BULK_FOLDER)
    e = delta(spark, sf_dir).select(*fields)
    write_feed(e.where(F.col("lastMotTestDate") < _split_col()), root, DELTA_OLD_FOLDER)
    write_feed(e.where(F.col("lastMotTestDate") >= _split_col()), root, DELTA_NEW_FOLDER)
    return root


def weekly_folders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two weeks of delta records.  The second changes and deletes vehicles that the first
    changed, and adds a DELETED record without any date for every other vehicle that
    the first created or updated."""
    e = delta(spark, sf_dir).select(*VEHICLE.fieldNames())
    first = e.where(F.col("lastMotTestDate") < _split_col())
    # a vehicle with dated records in the second week is decided by those
    second = e.where(F.col("lastMotTestDate") >= _split_col())
    gone = (first.where(F.col("modification").isin(CREATED, UPDATED)).select("registration").distinct()
            .join(second.select("registration"), "registration", "left_anti"))
    deletes = gone.select(*[F.lit(DELETED).alias(f.name) if f.name == "modification"
                            else F.col("registration") if f.name == "registration"
                            else F.lit(None).cast(f.dataType).alias(f.name) for f in VEHICLE.fields])
    return first, second.unionByName(deletes)


def write_corrupt_feed_fixture(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """F1 as a bulk folder and F2 as a delta folder (gz text files) where some lines are
    truncated JSON (vehicles on diesel, 'error' events) and others are followed by a
    blank line (vehicles that were never tested, 'view' events)."""
    from inspecta.session import scratch_dir
    root = root or scratch_dir(spark, "feed-corrupt")
    from inspecta.sources.feed import TS_WRITE_FORMAT
    js = F.to_json(F.struct(*[F.col(c) for c in VEHICLE.fieldNames()]),
                   {"timestampNTZFormat": TS_WRITE_FORMAT})
    bulk, e = history(spark, sf_dir), delta(spark, sf_dir)
    for folder, rows, bad, blank in ((BULK_FOLDER, bulk, F.col("fuelType") == "DIESEL", F.col("lastMotTestDate").isNull()),
                                     (DELTA_NEW_FOLDER, e, F.col("model") == "error", F.col("model") == "view")):
        lines = rows.select(F.when(bad, F.substring(js, 1, 25)).otherwise(js).alias("value"))
        blanks = rows.where(blank).select(F.lit("").alias("value"))
        lines.unionByName(blanks).write.mode("overwrite").option("compression", "gzip").text(f"{root}/{folder}")
    return root
