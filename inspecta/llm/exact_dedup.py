"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. A Misra-Gries summary (Spark's frequent-items sketch, ``approx_top_k``) over
   64-bit digests finds digests that may be frequent.  Partitions are summarised
   apart, combined in two levels, and the summary has ``tracked`` counters, so
   its size doesn't depend on the data.
2. The rows of those digests are counted exactly by their full SHA-256 digest
   (partial aggregation, so a hot digest leaves each task as one row).  At most
   ``top`` verified winners are broadcast.
3. Rows of a winner digest that can't be the row that stays are decided, or
   removed, map-side.  All other rows take one ordinary shuffle by digest.

A digest that the summary misses only takes the ordinary way; the result is the
same for any ``tracked`` and ``top``.

Defined cases: null text equals empty text.  Of rows with equal texts the one
with the largest doc_id stays; a null doc_id comes after every other.  If rows
repeat both text and doc_id, one of them stays.  An empty table gives no rows.
Columns of the input may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inspecta.llm.base import free_name

TRACKED = 2048      # counters of the summary
TOP = 256           # digests that may be broadcast
MIN_ROWS = 16       # a verified digest with fewer rows takes the ordinary way
GROUPS = 64         # first-level merges of partition summaries


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def frequent_digests(rows: DataFrame, tracked: int = TRACKED, top: int = TOP,
                     min_rows: int = MIN_ROWS) -> DataFrame:
    """Verified winners (w_sha, w_keep, w_size) of ``rows`` (doc_id, sha);
    at most about ``top`` rows."""
    # the last merge has a key, of one value: without a key, a partition that has no
    # rows gives an empty summary, which this Spark version can't combine
    keyed = rows.select(F.xxhash64("sha").alias("h"), F.spark_partition_id().alias("p"))
    one = (keyed.groupBy((F.col("p") % GROUPS).alias("g"))
           .agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"))
           .groupBy((F.col("g") >= 0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
           .select(F.explode(F.expr(f"approx_top_k_estimate(s, {top})")).alias("e"))
           .where(F.col("e.count") >= min_rows)
           .select(F.col("e.item").alias("h")))
    may = rows.join(F.broadcast(one), F.xxhash64("sha") == F.col("h"), "left_semi")
    best = (may.groupBy("sha", "doc_id").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("sha").agg(F.max("doc_id").alias("w_keep"), F.sum("n").alias("w_size")))
    return best.where(F.col("w_size") >= min_rows).withColumnRenamed("sha", "w_sha")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             tracked: int = TRACKED, top: int = TOP, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), digest(docs[text_col]).alias("sha"))
    win = F.broadcast(frequent_digests(rows, tracked, top, min_rows))
    tagged = rows.join(win, rows.sha == win.w_sha, "left")
    loses = F.col("w_sha").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("w_keep"))
    decided = tagged.where(loses).select(
        "doc_id", F.col("w_keep").alias("keep_id"), F.col("w_size").alias("group_size"),
        F.lit(False).alias("kept"), F.col("sha").alias("text_sha256"))
    group = Window.partitionBy("sha")
    rest = tagged.where(~loses).select(
        "doc_id",
        F.coalesce("w_keep", F.max("doc_id").over(group)).alias("keep_id"),
        F.coalesce("w_size", F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.desc_nulls_last("doc_id"))) == 1).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return decided.unionByName(rest)


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tracked: int = TRACKED, top: int = TOP, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all and only its columns."""
    sha, wsha, wkeep, pos = (free_name(docs, c) for c in ("x_sha", "x_wsha", "x_wkeep", "x_pos"))
    full = docs.withColumn(sha, digest(docs[text_col]))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), digest(docs[text_col]).alias("sha"))
    win = F.broadcast(frequent_digests(rows, tracked, top, min_rows)
                      .select(F.col("w_sha").alias(wsha), F.col("w_keep").alias(wkeep)))
    tagged = full.join(win, full[sha] == win[wsha], "left")
    loses = F.col(wsha).isNotNull() & ~F.col(id_col).cast("long").eqNullSafe(F.col(wkeep))
    first = F.row_number().over(Window.partitionBy(sha).orderBy(F.desc_nulls_last(F.col(id_col).cast("long"))))
    return (tagged.where(~loses).withColumn(pos, first).where(F.col(pos) == 1)
            .drop(sha, wsha, wkeep, pos))
