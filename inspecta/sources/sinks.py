"""Table sinks: append / overwrite, partitioned layouts, staging, flat CSV."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage(batches: list[DataFrame]) -> DataFrame:
    """Union of staged batches; columns missing in a batch become NULL.

    The first batch 'truncates' and later ones 'append': in a batch job this
    is just the union, no physical staging table is needed.
    """
    if not batches:
        raise ValueError("no batches to stage")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> str:
    """Append (``mode='append'``) or truncate-and-load (``'overwrite'``).

    Never overwrite a path that the same job reads: Spark deletes the target
    before the read happens.  Use ``write_version`` for in-place updates.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def create_main(df: DataFrame, path: str, num_partitions: int | None = None,
                day_col: str = "lastMotTestDate") -> str:
    """Main table partitioned by day of ``lastMotTestDate`` (``p_day``).

    Rows are range-partitioned on (day, registration) before the write: the
    sampled range bounds split a hot day over several tasks in proportion to
    its size and pack small days together, so files per day follow the data
    and every task writes a few contiguous day folders.
    """
    out = df.withColumn("p_day", F.to_date(day_col))
    keys = [F.col("p_day"), F.col("registration")]
    out = (out.repartitionByRange(num_partitions, *keys) if num_partitions
           else out.repartitionByRange(*keys))
    # a full replacement: static overwrite (no per-partition staging and renames)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("p_day").parquet(path))
    return path


def write_daily_counts(df: DataFrame, path: str) -> str:
    """Replace the counts table, partitioned by month (``p_month``).

    A refresh replaces the whole table: its window usually starts inside a
    month, so keeping months that it doesn't hold, or only replacing those it
    does, would mix counts of two runs.
    """
    out = df.withColumn("p_month", F.trunc(F.to_date("test_date"), "MONTH"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("p_month").parquet(path))
    return path


def read_daily_counts(spark: SparkSession, path: str) -> DataFrame:
    """Read the counts table with its declared schema (works when a refresh
    found no rows and wrote no data files)."""
    from inspecta.schema import DAILY_COUNTS
    return spark.read.schema(DAILY_COUNTS + ", p_month date").parquet(path)


def drop_stage(spark: SparkSession, name: str) -> None:
    """Drop a staging table if it exists."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})


# ---- versioned tables: copy-on-write without a table format -----------------
def table_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions (folders ``v=N`` holding a ``_SUCCESS`` marker), listed
    through Hadoop's file system, so any path that Spark writes works."""
    from inspecta.session import hadoop_path
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [(i.getPath().getName(), i) for i in fs.listStatus(root) if i.isDirectory()]
    return sorted(int(name[2:]) for name, i in found
                  if name.startswith("v=") and name[2:].isdigit() and fs.exists(new(i.getPath(), "_SUCCESS")))


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write ``df`` as the next version; readers switch when it is committed.

    The job commit writes ``_SUCCESS`` last, so a failed or running write is
    never visible, and the previous version stays readable meanwhile.  One
    writer at a time: the number is not locked, and a second writer that took
    the same one fails, as its folder exists.
    """
    versions = table_versions(df.sparkSession, path)
    n = (versions[-1] + 1) if versions else 1
    write_table(df, f"{path.rstrip('/')}/v={n:06d}", "errorifexists", partition_by)
    return n


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    versions = table_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/v={versions[-1]:06d}")


# ---- flat export (SNK8) --------------------------------------------------------
def to_flat(df: DataFrame) -> DataFrame:
    """15-column flat form: text columns ('' when missing), test count, tests as JSON."""
    from inspecta.schema import FLAT_COLUMNS

    def text(c: str):
        if c not in df.columns:
            return F.lit("")
        t = df.schema[c].dataType.simpleString()
        if t.startswith("timestamp"):
            v = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif t == "date":
            v = F.date_format(c, "yyyy-MM-dd")
        else:
            v = F.col(c).cast("string")
        return F.coalesce(v, F.lit(""))

    tests = F.coalesce(F.col("motTests"), F.array().cast(df.schema["motTests"].dataType))
    cols = []
    for c in FLAT_COLUMNS:
        if c == "motTestCount":
            cols.append(F.size(tests).alias(c))
        elif c == "motTests":
            cols.append(F.to_json(tests, {"ignoreNullFields": "false"}).alias(c))
        else:
            cols.append(text(c).alias(c))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    """Flat CSV with a header; quotes inside a field are doubled (RFC 4180)."""
    to_flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


# ---- bucketed main table: co-located merges without shuffling main ------------
def write_bucketed(df: DataFrame, table: str, path: str, buckets: int,
                   key: str = "registration") -> str:
    """Save ``df`` as an external table at ``path``, bucketed and sorted by ``key``.

    Each bucket is written by one task (one file per bucket).  Joins on
    ``key`` against a side hash-partitioned into the same number of buckets
    need no shuffle of this table.
    """
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return table
