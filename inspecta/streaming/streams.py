"""Structured Streaming jobs: incremental feed ingest, per-batch upsert, alerts.

File sources remember the files they have processed in the checkpoint, so a
rerun picks up only new feed files (each file is processed once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta.operators.merge import valid_delta
from inspecta.schema import DELETED, VEHICLE
from inspecta.sources.feed import CORRUPT, _with_corrupt, feed_glob, tag_feed_date

BUDGET = T.StructType([T.StructField("costAmount", T.DoubleType()),
                       T.StructField("budgetAmount", T.DoubleType())])


def stream_feed(spark: SparkSession, root: str, kind: str | None = "delta",
                schema: T.StructType = VEHICLE, max_files_per_trigger: int | None = None,
                ext: str = "*.json.gz") -> DataFrame:
    """Streaming read of feed folders; rows carry the source file and feed date.

    ``max_files_per_trigger`` splits new files over batches, which changes the
    order they apply in (see ``start_upsert``)."""
    r = (spark.readStream.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.json(feed_glob(root, kind, ext))
    return tag_feed_date(df.withColumn("_source_file", F.col("_metadata.file_path")))


def ingest(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True):
    """Append the parsed feed to a parquet table; returns the started query."""
    w = (stream.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_upsert(stream: DataFrame, table: str, checkpoint: str, as_of=None,
                 key: str = "registration", available_now: bool = True, order: str = "last_test",
                 report: list | None = None, **upsert_kw):
    """Apply each micro-batch of delta records to a versioned main table.

    Per batch: valid modifications -> dedupe -> enrich -> upsert -> new
    table version.  Replaying a batch after a failure is harmless: applying
    the same delta twice gives the same table as applying it once.  Records
    with a NULL key are dropped here: they would be inserted again by a replay.

    Batches apply in the order the source finds the files, so a limit on files
    per trigger (``stream_feed``) makes a later file win over an earlier one
    whatever its dates; without it all new files are one batch, deduped together
    by ``order`` ('last_test' or 'feed_date').  ``report`` collects one
    (batch, action, rows) entry per merge action of each batch.
    """
    from inspecta.operators.merge import prepare_delta, upsert
    from inspecta.sources.sinks import read_latest, write_version

    def apply(batch: DataFrame, epoch_id: int) -> None:
        good = batch.where(F.col(CORRUPT).isNull() & F.col(key).isNotNull()).drop(CORRUPT, "_source_file")
        # cut here: the report and the merge read it
        prepared = prepare_delta(good, as_of, key, order).checkpoint(eager=True)
        current = read_latest(batch.sparkSession, table)
        counts = Observation() if report is not None else None      # taken by the write itself
        write_version(upsert(current, prepared, key, duplicates="trust", checkpoint=False, report=counts, **upsert_kw), table)
        if counts is not None:
            report.extend((epoch_id, action, rows) for action, rows in counts.get.items() if rows)

    from inspecta.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(stream.sparkSession)
    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


# ---- newest record per key across batches (keyed state) --------------------------
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "true"}


def newest_records(stream: DataFrame, key: str = "registration", order: str = "last_test") -> DataFrame:
    """Records of a stream that are newer than every record of their key before, in this
    and all earlier batches; of a batch the newest.  Same columns.

    A record's rank is (last test, feed date, DELETED, hash), in the chosen order of the first
    two; a missing date is older than any.  It is one text that sorts like it.  The state is
    a streaming aggregate: of each key the record of the highest rank and the time of the
    batch that it came in, the earliest of equal ranks.  A batch passes on the records that
    came in it.  The state is in RocksDB on the executors with its log in the stream's
    checkpoint, so what is passed on last for a key doesn't depend on how the files are
    dealt into batches.  Records without a key are dropped."""
    if order not in ("last_test", "feed_date"):
        raise ValueError("order must be 'last_test' or 'feed_date'")
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    text = lambda c, form: F.coalesce(F.date_format(c, form), F.lit(""))      # noqa: E731
    dates = [text("lastMotTestDate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), text("feed_date", "yyyy-MM-dd") if "feed_date" in stream.columns else F.lit("")]
    if order == "feed_date":
        dates.reverse()
    # parts have a fixed width or are empty, and a space sorts before what is in them
    rank = F.concat_ws(" ", *dates, F.when(F.col("modification") == DELETED, "1").otherwise("0"),
                       F.lpad(F.hex(F.xxhash64(*stream.columns)), 16, "0"))
    now = F.unix_micros(F.current_timestamp())        # of a stream: the time of the batch
    rows = (valid_delta(stream).where(F.col(key).isNotNull())
            .select(F.col(key).cast("string").alias("key"), rank.alias("rank"), (-now).alias("since"),
                    F.to_json(F.struct(*stream.columns), _TIMES).alias("record")))
    out = (rows.groupBy("key").agg(F.max(F.struct("rank", "since", "record")).alias("best"))
           .where(F.col("best.since") == -now).select("best.record"))
    return out.select(F.from_json("record", stream.schema, _TIMES).alias("r")).select("r.*")


def start_log(stream: DataFrame, path: str, checkpoint: str, as_of=None, key: str = "registration",
              order: str = "last_test", available_now: bool = True):
    """Append the newest records of each micro-batch to a merge-on-read table
    (``changelog``).  An append costs the batch, not main.

    Read the table with ``in_turn=False``: then the rows don't depend on the files per
    trigger, nor on their order.  A replayed batch adds the same records again, which
    changes nothing.  Compaction makes deletes final."""
    from inspecta.operators import changelog
    from inspecta.operators.merge import prepare_delta
    good = stream.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_source_file")

    def apply(batch: DataFrame, _epoch_id: int) -> None:
        changelog.append(prepare_delta(batch, as_of, key, order), path)

    w = (newest_records(good, key, order).writeStream.outputMode("update").foreachBatch(apply)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def decode_budget(df: DataFrame, data_col: str = "data") -> DataFrame:
    """base64 message body -> costAmount, budgetAmount."""
    body = F.from_json(F.unbase64(F.col(data_col)).cast("string"), BUDGET)
    return df.withColumn("_b", body).select("*", "_b.costAmount", "_b.budgetAmount").drop("_b")


def budget_overruns(df: DataFrame, data_col: str = "data") -> DataFrame:
    """Messages whose cost exceeds the budget (batch or streaming input)."""
    return decode_budget(df, data_col).where(F.col("costAmount") > F.col("budgetAmount"))
