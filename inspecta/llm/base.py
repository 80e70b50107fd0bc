"""Shared helpers: table reader, free column names, Arrow task functions."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inspecta.session import scratch_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns (doc_id, text) that most operators read; null text is empty."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint directory and
    read it back: the lineage is cut and every executor can read the files."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within this, Spark deletes a query's shuffle files as soon as the query has ended, and
    not whenever the driver happens to collect its garbage.  For the passes of a job that
    store what they find: a later pass reads the stored rows and no earlier shuffle."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within this, queries that run hand their rows to Python by at most so many at once (Spark's
    10,000, of long texts, are tens of MB in the executor and again in each Python worker)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def first_by_hash(rows: DataFrame, group: str, id_: str, n: int, ranges: int = 1 << 16) -> DataFrame:
    """The ``n`` rows of each ``group`` whose ``id_`` has the smallest hash.

    Hash ranges are counted by partial sums, which tells the range that holds the
    n-th row; only rows up to it are ranked, so no task sorts a whole group."""
    at = rows.withColumn("_range", F.pmod(F.xxhash64(id_), F.lit(ranges)))
    upto = F.sum("count").over(Window.partitionBy(group).orderBy("_range"))
    cut = (at.groupBy(group, "_range").count().withColumn("upto", upto).where(F.col("upto") - F.col("count") < n)
           .groupBy(group).agg(F.max("_range").alias("_cut")))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_range", F.xxhash64(id_), id_))
    return (at.join(cut, group).where(F.col("_range") <= F.col("_cut")).withColumn("_rank", rank)
            .where(F.col("_rank") <= n).select(*rows.columns))


def give_back() -> None:
    """Hand freed memory back to the system.  A Python worker goes on to other tasks and stages, and
    what its allocators keep for later counts as the executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim:
        trim(0)


def map_rows(df: DataFrame, fn: Callable, schema: str, max_rows: int = 0) -> DataFrame:
    """``mapInArrow`` where ``fn(table) -> dict of columns`` (or None) handles one
    Arrow batch; ``schema`` is the DDL of the result."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    ship_package(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max_rows or max(1, batch.num_rows)
            for k in range(0, batch.num_rows, step):
                out = fn(batch.slice(k, step))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
            out = None
            give_back()
    return df.mapInArrow(run, schema)
