"""Merge-on-read: deltas are appended to a log, reads see the newest state of each key,
and compaction rewrites only the key buckets that deltas touched.

Plain folders, no table format.  ``data/<id>/_bucket=K`` holds the base rows of bucket K
(a hash of the key), ``log/<id>`` one delta.  The manifest, a small versioned table that
is committed by its ``_SUCCESS`` marker, names the folder of each bucket, the last delta
that it holds, and the deltas since with the buckets they touch.  A write adds folders
and then commits a manifest, so readers see all of it or nothing; folders of earlier
manifests are left alone and stay readable.  One writer at a time.

An append costs the delta, not main.  A read passes buckets without newer deltas
through as they are; in the others the log is reduced to one record per key and merged
like a MERGE (``merge.merged_rows``).  What the sequence of deltas would give is kept: a
key deleted by one delta and written by a later one loses the columns that the MERGE
doesn't set.  The manifest has a row per bucket and open delta, which come to the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta.operators.merge import choose_strategy, maybe_broadcast, merged_rows, valid_delta
from inspecta.schema import DELETED, MERGE_SET_COLUMNS
from inspecta.session import hadoop_path
from inspecta.sources.sinks import read_latest, write_version

MANIFEST = "kind string, bucket int, seq bigint, folder string, touched array<int>, note string"


@dataclass(frozen=True)
class Manifest:
    key: str
    schema: T.StructType                       # of main
    delta: T.StructType | None                 # of the deltas
    base: dict[int, tuple[int, str | None]]    # bucket -> (last delta it holds, folder or None if empty)
    log: dict[int, tuple[str, list[int]]] = field(default_factory=dict)      # delta -> (folder, buckets)
    last: int = 0

    def pending(self, bucket: int) -> list[int]:
        """The deltas that a bucket's base doesn't hold yet."""
        return [s for s, (_, touched) in self.log.items() if s > self.base[bucket][0] and bucket in touched]


def _commit(spark: SparkSession, path: str, m: Manifest) -> None:
    note = json.dumps({"key": m.key, "schema": m.schema.json(), "delta": m.delta.json() if m.delta else None})
    rows = [("table", None, m.last, None, None, note)]
    rows += [("base", b, s, f, None, None) for b, (s, f) in m.base.items()]
    rows += [("log", None, s, f, t, None) for s, (f, t) in m.log.items()]
    write_version(spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> Manifest:
    rows = read_latest(spark, f"{path}/manifest").collect()
    table = next(r for r in rows if r.kind == "table")
    note = json.loads(table.note)
    parse = lambda s: T.StructType.fromJson(json.loads(s)) if s else None       # noqa: E731
    return Manifest(note["key"], parse(note["schema"]), parse(note["delta"]),
                    {r.bucket: (r.seq, r.folder) for r in rows if r.kind == "base"},
                    {r.seq: (r.folder, list(r.touched)) for r in sorted(rows, key=lambda r: r.seq) if r.kind == "log"}, table.seq)


def _set_columns(schema: T.StructType, key: str) -> list[str]:
    return [c for c in MERGE_SET_COLUMNS if c in schema.fieldNames() and c != key]


def bucket_of(schema: T.StructType, key: str, buckets: int) -> Column:
    """The bucket of a row of main or of a delta.  Rows without a key are spread by the
    columns that a MERGE sets, which an insert takes over from its record."""
    spread = F.xxhash64(F.col(key).cast("string"), *_set_columns(schema, key))
    return F.pmod(F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string"))).otherwise(spread), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, path: str, count: int) -> dict[int, str]:
    """Base rows with ``_bucket`` as one folder per bucket; the folders that have rows."""
    spark, root = df.sparkSession, f"{path}/data/{uuid.uuid4().hex}"
    # one task a bucket; (static) overwriting of other folders can't happen, the root is new
    df.repartition(count, "_bucket").write.mode("errorifexists").option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(root)
    fs, p = hadoop_path(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {int(n.split("=")[1]): f"{root}/{n}" for n in names if n.startswith("_bucket=")}


def create(main: DataFrame, path: str, buckets: int, key: str = "registration") -> None:
    """A new table of the rows of ``main``.  Choose buckets that a task can hold."""
    path = path.rstrip("/")
    folders = _write_buckets(main.withColumn("_bucket", bucket_of(main.schema, key, buckets)), path, buckets)
    _commit(main.sparkSession, path, Manifest(key, main.schema, None, {b: (0, folders.get(b)) for b in range(buckets)}))


def append(delta: DataFrame, path: str) -> int:
    """Add a prepared delta (at most one record per key); returns its number."""
    spark, path = delta.sparkSession, path.rstrip("/")
    m = manifest(spark, path)
    keep = _set_columns(m.schema, m.key)
    missing = [c for c in keep if c not in delta.columns]
    if missing:
        raise ValueError(f"the delta lacks columns that the merge sets: {missing}")
    d = valid_delta(delta).select(m.key, *keep, *[c for c in ("modification",) if c not in keep])
    folder = f"{path}/log/{uuid.uuid4().hex}"
    d.withColumn("_bucket", bucket_of(m.schema, m.key, len(m.base))).write.mode("errorifexists").parquet(folder)
    read = spark.read.schema(_log_schema(d.schema)).parquet(folder)
    touched = sorted(r[0] for r in read.select("_bucket").distinct().collect())      # at most one row a bucket
    _commit(spark, path, replace(m, delta=d.schema, last=m.last + 1, log={**m.log, m.last + 1: (folder, touched)}))
    return m.last + 1


def _log_schema(delta: T.StructType) -> T.StructType:
    return T.StructType([*delta.fields, T.StructField("_bucket", T.IntegerType())])


def _base(spark: SparkSession, m: Manifest, buckets: list[int]) -> DataFrame:
    folders = [m.base[b][1] for b in buckets if m.base[b][1]]
    return spark.read.schema(m.schema).parquet(*folders) if folders else spark.createDataFrame([], m.schema)


def _open_log(spark: SparkSession, m: Manifest, buckets: list[int]) -> DataFrame | None:
    """The pending records of some buckets with ``_seq``."""
    out = None
    for s, (folder, touched) in m.log.items():
        wanted = [b for b in buckets if b in touched and s > m.base[b][0]]
        if wanted:
            part = spark.read.schema(_log_schema(m.delta)).parquet(folder).where(F.col("_bucket").isin(wanted)).withColumn("_seq", F.lit(s))
            out = part if out is None else out.unionByName(part)
    return out


def _merged(spark: SparkSession, m: Manifest, buckets: list[int], strategy: str, in_turn: bool, **settings) -> DataFrame:
    """Rows of some buckets with their pending deltas applied."""
    log = _open_log(spark, m, buckets)
    base = _base(spark, m, buckets)
    if log is None:
        return base
    key, cols = m.key, [f.name for f in m.delta.fields]
    gone = F.col("modification") == DELETED
    newest = (log.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
              .agg(F.max_by(F.struct(*cols), "_seq").alias("r"), F.max("_seq").alias("at"), F.max(F.when(gone, F.col("_seq"))).alias("gone")))
    from inspecta.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    newest = newest.select("r.*", (F.col("gone") < F.col("at")).alias("_anew")).checkpoint(eager=True)
    delta = newest.drop("_anew").unionByName(log.where(F.col(key).isNull()).select(*cols))
    # deleted by one delta, written by a later one: nothing of the old row stays
    anew = newest.where("_anew").select(key)
    if in_turn and anew.limit(1).count():
        base = base.join(maybe_broadcast(anew), key, "left_anti").select(*base.columns)
    form, n = choose_strategy(newest, key, strategy)
    rows = merged_rows(base, delta, key, _set_columns(m.schema, key), form, n, "_action", **settings)
    return rows.where(~F.col("_action").isin("delete", "ignore")).drop("_action")


def read(spark: SparkSession, path: str, strategy: str = "auto", in_turn: bool = True, **settings) -> DataFrame:
    """The table's rows now: untouched buckets as they are, the others merged with the log.

    ``in_turn``: as if the deltas were applied one after the other.  Otherwise only each
    key's newest record acts, as if all open deltas were one."""
    m = manifest(spark, path.rstrip("/"))
    touched = [b for b in m.base if m.pending(b)]
    rest = _base(spark, m, [b for b in m.base if b not in set(touched)])
    return rest.unionByName(_merged(spark, m, touched, strategy, in_turn, **settings)) if touched else rest


def compact(spark: SparkSession, path: str, buckets: list[int] | None = None, strategy: str = "auto",
            in_turn: bool = True, **settings) -> list[int]:
    """Rewrite the touched buckets (of ``buckets``, default all) with their deltas applied;
    the others keep their folders.  Returns the buckets rewritten.  Deltas that no
    bucket waits for leave the log."""
    path = path.rstrip("/")
    m = manifest(spark, path)
    todo = [b for b in (m.base if buckets is None else buckets) if m.pending(b)]
    if not todo:
        return []
    rows = _merged(spark, m, todo, strategy, in_turn, **settings)
    folders = _write_buckets(rows.withColumn("_bucket", bucket_of(m.schema, m.key, len(m.base))), path, len(todo))
    new = replace(m, base={b: (m.last, folders.get(b)) if b in todo else v for b, v in m.base.items()})
    open_ = {s: v for s, v in new.log.items() if any(s in new.pending(b) for b in v[1])}
    _commit(spark, path, replace(new, log=open_))
    return todo
