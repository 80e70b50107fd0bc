"""Vehicle feed readers: folders of gz NDJSON, zip archives, feed-date tags.

Layout (one JSON object per line):

    <root>/delta-light-vehicle_DD-MM-YYYY/*.json.gz
    <root>/bulk-light-vehicle_DD-MM-YYYY/*.json.gz
    <root>/delta-light-vehicle_DD-MM-YYYY.zip        (same content, zipped)

gz files cannot be split, so each file is one read task; ``partitions``
spreads the parsed rows round-robin afterwards when later stages need it.
"""

from __future__ import annotations

import gzip
import io
import itertools
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta.functions.columns import feed_date_from_path, feed_date_string
from inspecta.schema import BULK_PREFIX, DELTA_PREFIX, VEHICLE

CORRUPT = "_corrupt_record"
# ISO-8601 with microseconds (the JSON writer's default keeps milliseconds only).
TS_WRITE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
KIND_PREFIX = {"delta": DELTA_PREFIX, "bulk": BULK_PREFIX}


def feed_glob(root: str, kind: str | None = None, ext: str = "*.json.gz") -> str:
    root = root.rstrip("/")
    if kind is None:
        return f"{root}/{{{DELTA_PREFIX},{BULK_PREFIX}}}*/{ext}"
    return f"{root}/{KIND_PREFIX[kind]}*/{ext}"


def tag_feed_date(df: DataFrame, path_col: str = "_source_file") -> DataFrame:
    """Add ``feed_date`` (folder date - 1 day) and the ``date`` text (dd-MM-yyyy or '')."""
    fd = feed_date_from_path(F.col(path_col))
    return df.withColumn("feed_date", fd).withColumn("date", feed_date_string(F.col("feed_date")))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def _read_json(spark: SparkSession, pattern: str, schema: T.StructType | None, corrupt: bool,
               sampling_ratio: float) -> DataFrame:
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(_with_corrupt(schema) if corrupt else schema)
    else:
        reader = reader.option("samplingRatio", sampling_ratio).option("prefersDecimal", False)
    df = reader.json(pattern)
    return tag_feed_date(df.withColumn("_source_file", F.col("_metadata.file_path")))


def read_feed(spark: SparkSession, root: str, kind: str | None = None,
              schema: T.StructType | None = VEHICLE, corrupt: bool = True,
              limit: int | None = None, limit_order: list[str] | None = None, sampling_ratio: float = 1.0,
              partitions: int | None = None, ext: str = "*.json.gz") -> DataFrame:
    """Read feed folders (``kind`` 'delta', 'bulk' or both) as a DataFrame.

    * explicit ``schema`` (default) or inference when ``schema=None``;
    * PERMISSIVE parsing: a malformed line becomes a row with only
      ``_corrupt_record`` set (see ``split_corrupt``); blank lines are skipped;
    * ``_source_file`` and the feed date tags are added;
    * ``limit`` keeps the first n records by ``limit_order`` (a top-k: each task
      keeps n); without an order, any n;
    * ``partitions`` spreads the parsed rows round-robin over that many
      partitions (gz files are one task each); round-robin, not by key, so
      many copies of one record cannot pile up in one task.
    """
    df = _read_json(spark, feed_glob(root, kind, ext), schema, corrupt, sampling_ratio)
    if limit is not None:
        df = (df.orderBy(*limit_order) if limit_order else df).limit(limit)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_latest_feed(spark: SparkSession, root: str, kind: str = "delta",
                     schema: T.StructType | None = VEHICLE, corrupt: bool = True,
                     ext: str = "*.json.gz") -> DataFrame:
    """Read only the newest dated feed folder.

    The folder is chosen from a path-only ``binaryFile`` listing (contents
    are not read), so older deltas are never opened or parsed.  Folders
    without a date in their name are ignored.
    """
    listing = (spark.read.format("binaryFile").load(feed_glob(root, kind, ext))
               .select(feed_folder("path").alias("folder"), feed_date_from_path(F.col("path")).alias("d"))
               .where(F.col("d").isNotNull()))
    newest = listing.orderBy(F.col("d").desc(), F.col("folder").desc()).limit(1).collect()
    if not newest:
        raise FileNotFoundError(f"no dated {kind} feed folder under {root}")
    pattern = f"{root.rstrip('/')}/{newest[0]['folder']}/{ext}"
    return _read_json(spark, pattern, schema, corrupt, 1.0)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows: file, key, raw text).

    The key column is kept next to the raw text (a line that parsed in part
    keeps it); Spark also refuses raw-file queries that read nothing but the
    corrupt-record column.
    """
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull()).select(
        "_source_file", "registration", F.col(CORRUPT).alias("raw"))
    return good, bad


def feed_folder(path_col: str = "_source_file"):
    """Name of the folder holding a file."""
    return F.regexp_extract(F.col(path_col), r"/([^/]+)/[^/]*$", 1)


def feed_stats(df: DataFrame) -> DataFrame:
    """Records per feed folder (partial + final count)."""
    return df.groupBy(feed_folder().alias("folder")).agg(F.count(F.lit(1)).alias("records"))


# ---- rows counted by the load itself (SRC7) -----------------------------------
def feed_folders(spark: SparkSession, root: str, kind: str | None = None) -> list[str]:
    """Names of the feed folders, from the listing."""
    from inspecta.session import hadoop_path
    prefixes = list(KIND_PREFIX.values()) if kind is None else [KIND_PREFIX[kind]]
    fs, _ = hadoop_path(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [s for p in prefixes for s in (fs.globStatus(path(f"{root.rstrip('/')}/{p}*")) or [])]
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def counted(df: DataFrame, folders: list[str], seen: Observation) -> DataFrame:
    """``df`` (as of ``read_feed``), whose good records per folder and malformed lines
    are counted while it is written; read them by ``load_counts``."""
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    per = [F.count_if(~bad & (feed_folder() == f)).alias(f"f{i}") for i, f in enumerate(folders)]
    return df.observe(seen, *per, F.count_if(bad).alias("malformed"))


def load_counts(folders: list[str], seen: Observation) -> dict[str, int]:
    """{folder: records loaded, 'malformed': lines} once the write has ended."""
    got = seen.get
    return {**{f: got[f"f{i}"] for i, f in enumerate(folders)}, "malformed": got["malformed"]}


# ---- schema as an aggregate (SRC5) ----------------------------------------------
def _json_type(t: T.DataType) -> T.DataType:
    """A variant's type as the JSON reader infers it: fractions are doubles, values of
    several types text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _json_type(f.dataType)) for f in sorted(t.fields, key=lambda f: f.name)])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_json_type(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.LongType() if t.scale == 0 and t.precision <= 18 else T.DoubleType()
    return T.StringType() if isinstance(t, T.VariantType) else t


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both: nothing below all, numbers below double, records by
    their fields, lists by their elements, all else below text."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        kinds = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            kinds[f.name] = widen(kinds.get(f.name, T.NullType()), f.dataType)
        return T.StructType([T.StructField(n, kinds[n]) for n in sorted(kinds)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    return T.DoubleType() if {type(a), type(b)} == {T.LongType, T.DoubleType} else T.StringType()


def _settled(t: T.DataType) -> T.DataType:
    """What was never more than null is text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    return T.StringType() if isinstance(t, T.NullType) else t


def _paths(t: T.DataType, at: str = "") -> dict[str, str]:
    if isinstance(t, T.StructType):
        return {p: k for f in t.fields for p, k in _paths(f.dataType, f"{at}.{f.name}" if at else f.name).items()}
    if isinstance(t, T.ArrayType):
        return _paths(t.elementType, at + "[]")
    return {at: _settled(t).simpleString()}


def folder_schemas(spark: SparkSession, root: str, kind: str | None = None, ext: str = "*.json.gz") -> dict[str, T.StructType]:
    """The schema of each feed folder, from one pass over its lines: the types of all
    records are reduced by partial aggregation, so a task sends one schema a folder."""
    from pyspark.sql.types import _parse_datatype_string
    lines = spark.read.text(feed_glob(root, kind, ext)).select(feed_folder("_metadata.file_path").alias("folder"), "value")
    found = (lines.select("folder", F.try_parse_json("value").alias("v")).groupBy("folder")
             .agg(F.schema_of_variant_agg("v").alias("s")).collect())      # one row a folder
    out = {}
    for r in sorted(found, key=lambda r: r.folder):
        t = _json_type(_parse_datatype_string(r.s.replace("OBJECT<", "STRUCT<")))
        out[r.folder] = t if isinstance(t, T.StructType) else T.StructType([])
    return out


def feed_schema(schemas: dict[str, T.StructType]) -> T.StructType:
    """One schema that reads every folder."""
    out: T.DataType = T.StructType([])
    for t in schemas.values():
        out = widen(out, t)
    return _settled(out)


def schema_drift(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    """(folder, path, type, feed_type): every field of the feed in every folder; type is
    NULL where the folder doesn't have it, and differs from feed_type where it drifts."""
    whole = _paths(feed_schema(schemas))
    rows = [(folder, p, _paths(t).get(p), k) for folder, t in schemas.items() for p, k in whole.items()]
    return spark.createDataFrame(rows, "folder string, path string, type string, feed_type string")


def latest_feed(df: DataFrame) -> DataFrame:
    """Only the records of the newest feed date (files carry no manifest order)."""
    newest = df.agg(F.max("feed_date")).scalar()
    return df.where(F.col("feed_date") == newest)


def normalise_feed(spark: SparkSession, root: str, out: str, kind: str | None = None,
                   schema: T.StructType = VEHICLE) -> str:
    """One NDJSON dataset per feed folder, every record tagged with ``date``.

    A single job: parsed records (corrupt lines dropped) are written as JSON
    partitioned by their source folder (``out/folder=<name>/part-*.json``);
    records keep their fields plus the ``date`` text (dd-MM-yyyy or '').
    """
    good, _bad = split_corrupt(read_feed(spark, root, kind, schema))
    cols = [c for c in schema.fieldNames()] + ["date"]
    # no repartition by folder: a large folder stays spread over its read tasks
    (good.select(*cols, feed_folder().alias("folder"))
     .write.mode("overwrite").option("timestampNTZFormat", TS_WRITE_FORMAT)
     .partitionBy("folder").json(out))
    return out


def write_feed(df: DataFrame, root: str, folder: str, mode: str = "overwrite") -> str:
    """Write records as gz NDJSON into ``root/folder``; NULL fields are omitted."""
    path = f"{root.rstrip('/')}/{folder}"
    (df.write.mode(mode).option("compression", "gzip")
     .option("timestampNTZFormat", TS_WRITE_FORMAT).option("timestampFormat", TS_WRITE_FORMAT)
     .json(path))
    return path


# ---- zip archives (SRC2) ---------------------------------------------------
_LINES = T.StructType([T.StructField("_source_file", T.StringType()),
                       T.StructField("line", T.StringType())])
_BATCH = 10_000
_CHUNK = 1 << 20


def _fs_path(path: str):
    """pyarrow file system and path of a Hadoop-style URI, for reads inside tasks:
    local paths in any form, hdfs (needs libhdfs there), s3 and its s3a name, gs."""
    from pyarrow import fs as pafs
    if path.startswith("file:"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    elif path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    elif "://" not in path:
        path = "file://" + path
    return pafs.FileSystem.from_uri(path)


def zip_members(path: str) -> list[str]:
    """Member names; only the archive's directory is read."""
    fs, p = _fs_path(path)
    with fs.open_input_file(p) as raw, zipfile.ZipFile(raw) as zf:
        return [i.filename for i in zf.infolist() if not i.is_dir()]


def zip_lines(path: str, name: str):
    """(source, line) of the non-blank lines of a member, streamed through the file
    system layer: memory stays bounded by the read buffers."""
    source = f"{path.removesuffix('.zip')}/{name.rsplit('/', 1)[-1]}"
    fs, p = _fs_path(path)
    with fs.open_input_file(p) as raw, zipfile.ZipFile(raw) as zf, zf.open(name) as m:
        stream = gzip.GzipFile(fileobj=m) if name.endswith(".gz") else m
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            line = line.strip()
            if line:
                yield source, line


def _zip_members(batches):
    """Archive paths -> one row per member."""
    for pdf in batches:
        yield pd.DataFrame([(path, name) for path in pdf["path"] for name in zip_members(path)], columns=["path", "member"])


def _zip_lines(batches):
    """(archive, member) -> one row per non-blank line, in batches of ``_BATCH`` lines."""
    for pdf in batches:
        for path, name in zip(pdf["path"], pdf["member"]):
            rows = zip_lines(path, name)
            while part := list(itertools.islice(rows, _BATCH)):
                yield pd.DataFrame(part, columns=["_source_file", "line"])


def read_feed_zip(spark: SparkSession, root: str, kind: str | None = "delta",
                  schema: T.StructType = VEHICLE) -> DataFrame:
    """Read ``*.zip`` feed archives of gz NDJSON members.

    Spark lists the archives (paths only, contents are not loaded) and then their
    members; each (archive, member) is streamed by a task of its own, and lines are
    parsed with ``from_json`` in the JVM (PERMISSIVE: a bad line gives
    ``_corrupt_record``).
    """
    from inspecta.session import ensure_checkpoint_dir, ship_package
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    prefix = "{" + DELTA_PREFIX + "," + BULK_PREFIX + "}" if kind is None else KIND_PREFIX[kind]
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{prefix}*.zip").select("path")
    members = files.mapInPandas(_zip_members, "path string, member string").checkpoint(eager=True)
    # round-robin over as many partitions as there are members
    lines = members.repartition(max(1, members.count())).mapInPandas(_zip_lines, _LINES)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select("_source_file", F.from_json("line", _with_corrupt(schema), opts).alias("r"))
    return tag_feed_date(parsed.select("r.*", "_source_file"))


class _Sink(io.RawIOBase):
    """Write-only, non-seekable view of an output stream (zip uses data descriptors)."""

    def __init__(self, out):
        self._out, self._n = out, 0

    def writable(self):
        return True

    def write(self, b):
        self._out.write(bytes(b))
        self._n += len(b)
        return len(b)

    def tell(self):
        return self._n


def write_feed_zip(files: DataFrame, root: str) -> DataFrame:
    """Pack each feed folder's gz files into ``root/<folder>.zip``.

    ``files`` lists the gz files (a ``binaryFile`` DataFrame; only ``path``
    is used, contents are not loaded).  One task per folder streams the
    members into the archive through pyarrow's filesystem layer (local, HDFS
    or object stores), chunk by chunk.  Returns (archive, members).
    """
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        folder = pdf["folder"].iloc[0]
        target = f"{root.rstrip('/')}/{folder}.zip"
        fs, p = _fs_path(target)
        paths = sorted(pdf["path"])
        with fs.open_output_stream(p, compression=None) as out, \
                zipfile.ZipFile(_Sink(out), "w", zipfile.ZIP_STORED) as zf:
            for path in paths:
                sfs, sp = _fs_path(path)
                with sfs.open_input_stream(sp, compression=None) as src, \
                        zf.open(path.rsplit("/", 1)[-1], "w", force_zip64=True) as dst:
                    while chunk := src.read(_CHUNK):
                        dst.write(chunk)
        return pd.DataFrame({"archive": [target], "members": [len(paths)]})

    from inspecta.session import ship_package
    ship_package(files.sparkSession)
    with_folder = files.select("path", F.regexp_extract("path", r"/([^/]+)/[^/]*$", 1).alias("folder"))
    return with_folder.groupBy("folder").applyInPandas(pack, "archive string, members long")
