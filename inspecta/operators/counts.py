"""Recent pass/fail counts and date windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inspecta.functions.columns import as_of_col
from inspecta.schema import DELETED, FAILED, PASSED


def recent(df: DataFrame, col: str, days: int, as_of=None) -> DataFrame:
    """Rows with DATE(col) >= as_of - days (no upper bound)."""
    return df.where(F.to_date(col) >= F.date_sub(as_of_col(as_of), days))


def around(df: DataFrame, col: str, days: int, as_of=None) -> DataFrame:
    """Rows with as_of - days <= col <= as_of + days (col is a date)."""
    d = as_of_col(as_of)
    return df.where(F.col(col).between(F.date_sub(d, days), F.date_add(d, days)))


def daily_counts(enriched: DataFrame, as_of=None, days: int = 60, grain: str = "timestamp") -> DataFrame:
    """Counts of vehicles by (last test time, last result) for PASSED/FAILED.

    Only each vehicle's *last* test is counted.  ``grain='timestamp'`` groups
    by the raw test timestamp as the reference does; ``grain='day'`` groups
    by calendar day.  Partial + final hash aggregation: a hot (date, result)
    group is combined map-side.
    """
    rows = recent(enriched, "last_test_date", days, as_of).where(
        F.col("last_test_result").isin(PASSED, FAILED))
    if grain == "timestamp":
        key = F.col("last_test_date")
    elif grain == "day":
        key = F.to_date("last_test_date").cast("timestamp_ntz")
    else:
        raise ValueError("grain must be 'timestamp' or 'day'")
    return (rows.groupBy(key.alias("test_date"), F.col("last_test_result").alias("result_type"))
            .agg(F.count(F.lit(1)).alias("count")))


# ---- counts kept up to date by the merge ----------------------------------------
def all_counts(enriched: DataFrame) -> DataFrame:
    """``daily_counts`` by timestamp without a window of days: what is kept up to date."""
    return (enriched.where(F.col("last_test_result").isin(PASSED, FAILED))
            .groupBy(F.col("last_test_date").alias("test_date"), F.col("last_test_result").alias("result_type"))
            .agg(F.count(F.lit(1)).alias("count")))


def count_changes(main: DataFrame, delta: DataFrame, key: str = "registration", **settings) -> DataFrame:
    """(test_date, result_type, change): what merging the prepared ``delta`` (at most one
    record per key) into ``main`` does to its counts.

    A row that goes or is replaced takes its old last test back (-1), a row that is
    written brings its new one (+1).  Only main's matching slice is read beyond its key."""
    from inspecta.operators.merge import _checkpointed, matching, valid_delta
    d = _checkpointed(valid_delta(delta).select(key, "modification", "last_test_date", "last_test_result"))
    old = matching(main.select(key, F.col("last_test_date").alias("_date"), F.col("last_test_result").alias("_result")), d, key, **settings)
    named = d.where(F.col(key).isNotNull()).join(old.withColumn("_old", F.lit(True)), key, "left")
    keyless = d.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema if f.name != key],
                                                  F.lit(None).cast("boolean").alias("_old"))
    minus = F.when(F.col("_old"), F.struct(F.col("_date").alias("test_date"), F.col("_result").alias("result_type"), F.lit(-1).cast("bigint").alias("change")))
    plus = F.when(F.col("modification") != DELETED, F.struct(F.col("last_test_date").alias("test_date"), F.col("last_test_result").alias("result_type"), F.lit(1).cast("bigint").alias("change")))
    return (named.unionByName(keyless).select(F.explode(F.array(minus, plus)).alias("c")).select("c.*")
            .where(F.col("result_type").isin(PASSED, FAILED))
            .groupBy("test_date", "result_type").agg(F.sum("change").alias("change")))


def apply_changes(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """The counts after the changes; what has come down to zero is gone."""
    both = counts.select("test_date", "result_type", "count").unionByName(
        changes.select("test_date", "result_type", F.col("change").alias("count")))
    return both.groupBy("test_date", "result_type").agg(F.sum("count").alias("count")).where("count <> 0")
