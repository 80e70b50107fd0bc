"""End-to-end jobs composed from the operators (one Spark job graph each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from inspecta.operators.counts import daily_counts
from inspecta.operators.enrich import enrich
from inspecta.operators.forecast import clean_seasonal_spikes, fill_daily, forecast_training, prediction_output
from inspecta.operators.seasonal import search_orders, seasonal_forecast
from inspecta.schema import ACTUAL_SUFFIX, FORECAST_SUFFIX
from inspecta.sources.feed import counted, feed_folders, load_counts, read_feed, split_corrupt
from inspecta.sources.sinks import write_table, write_version


def load_feed(spark: SparkSession, feed_root: str, path: str, kind: str | None = None, mode: str = "append",
              partitions: int | None = None) -> dict[str, int]:
    """Feed folders -> staging table at ``path``; returns the records loaded per folder and
    the malformed lines, counted by the load itself."""
    folders, seen = feed_folders(spark, feed_root, kind), Observation()
    good, _bad = split_corrupt(counted(read_feed(spark, feed_root, kind=kind, partitions=partitions), folders, seen))
    write_table(good, path, mode)
    return load_counts(folders, seen)


def bulk_load(spark: SparkSession, feed_root: str, table: str, as_of=None,
              partitions: int | None = None) -> int:
    """Bulk feed -> enrich -> first version of the main table.

    gz files cannot be split, so one large file is parsed by one task;
    ``partitions`` spreads the parsed rows round-robin so that
    enrichment and the write are balanced whatever the file sizes.
    """
    good, _bad = split_corrupt(read_feed(spark, feed_root, kind="bulk", partitions=partitions))
    return write_version(enrich(good.drop("_source_file"), as_of), table)


def weekly_delta_ingest(spark: SparkSession, feed_root: str, table: str, checkpoint: str, as_of=None,
                        order: str = "last_test", zips: bool = False, **upsert_kw) -> list[tuple[int, str, int]]:
    """New delta files -> valid -> dedupe -> enrich -> upsert -> next table version.

    The job is a file stream that runs until it has taken all files present
    (``availableNow``).  ``checkpoint`` remembers them, so each is applied once
    and a vehicle that a later delta deletes stays deleted.  With ``zips`` the files are
    the archives of the feed.  Returns the rows affected, counted by the write:
    (batch, action, rows); empty if there was no new file.
    """
    from inspecta.sources.zips import stream_zips
    from inspecta.streaming.streams import start_upsert, stream_feed
    report: list[tuple[int, str, int]] = []
    start_upsert((stream_zips if zips else stream_feed)(spark, feed_root, kind="delta"), table, checkpoint, as_of, order=order,
                 report=report, **upsert_kw).awaitTermination()
    return report


def predict(train: DataFrame, horizon: int = 30) -> DataFrame:
    """Training series -> regular grid -> cleaned -> order search -> forecast."""
    clean = clean_seasonal_spikes(fill_daily(train).drop("filled")).drop("is_spike")
    return seasonal_forecast(search_orders(clean), horizon)


def analytics(main: DataFrame, as_of=None, horizon: int = 30, years: int = 3) -> dict[str, DataFrame]:
    """main -> daily counts -> training series -> forecast -> chart view.

    The counts table is small and read by three stages (training, cutoff,
    blend); it is checkpointed once, like the table the original job writes.
    """
    from inspecta.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(main.sparkSession)
    counts = daily_counts(main, as_of).checkpoint(eager=True)
    train = forecast_training(counts, as_of, years)
    fc = predict(train, horizon)
    return {"daily_counts": counts, "forecast": fc,
            "prediction_output": prediction_output(counts, fc, as_of)}


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> list[str]:
    """Create-or-replace a temp view per frame (the warehouse views)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def create_chart_view(spark: SparkSession, name: str, counts_path: str, forecast_path: str,
                      as_of=None, days: int = 30) -> str:
    """A persistent view of the session's catalog that blends the stored counts and
    forecasts when it is read; without ``as_of`` it moves with the current day."""
    day = "current_date()" if as_of is None else f"DATE '{as_of}'"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT * FROM (
          SELECT to_date(test_date) AS test_date, result_type || '{ACTUAL_SUFFIX}' AS chart_series,
                 CAST(count AS DOUBLE) AS count
          FROM parquet.`{counts_path}` WHERE to_date(test_date) < {day}
          UNION ALL
          SELECT to_date(forecast_timestamp), result_type || '{FORECAST_SUFFIX}',
                 if(forecast_value IS NULL, NULL, greatest(forecast_value, 0D))
          FROM parquet.`{forecast_path}` WHERE to_date(forecast_timestamp) >= {day})
        WHERE test_date BETWEEN {day} - INTERVAL {int(days)} DAY AND {day} + INTERVAL {int(days)} DAY""")
    return name
