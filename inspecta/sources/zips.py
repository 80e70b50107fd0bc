"""Zip archives of feed files as a Spark data source, for batch and stream reads.

``spark.dataSource.register(ZipFeed)``, then ``spark.read.format("feed_zip")`` or
``spark.readStream.format("feed_zip")`` with the options ``path`` (a folder) and
``prefix`` (archive names begin with it; several by comma).  One partition per archive
member, which a task streams line by line; rows are (source, line).

A stream's offset is the set of archives it has seen, so each archive is read once,
whatever its name or date, and a rerun on the same checkpoint adds nothing.  An archive
must be complete when it appears (write it elsewhere and rename it).  Archives are found
and read through pyarrow's file systems: local paths, HDFS, S3 and GCS addresses.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from inspecta.schema import VEHICLE
from inspecta.sources.feed import CORRUPT, KIND_PREFIX, _fs_path, _with_corrupt, tag_feed_date, zip_lines, zip_members

FORMAT = "feed_zip"


class Member(InputPartition):
    """One member of an archive."""

    def __init__(self, archive: str, name: str):
        super().__init__((archive, name))
        self.archive, self.name = archive, name


def archives(options: dict) -> list[str]:
    """The archives of a folder whose names begin with one of the prefixes."""
    from pyarrow import fs as pafs
    root = options["path"].rstrip("/")
    prefixes = tuple(options.get("prefix", "").split(","))
    fs, path = _fs_path(root)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(f"{root}/{f.base_name}" for f in found
                  if f.is_file and f.base_name.endswith(".zip") and f.base_name.startswith(prefixes))


def _members(paths: list[str]) -> list[Member]:
    return [Member(p, name) for p in paths for name in zip_members(p)]


def _rows(partition: Member) -> Iterator[tuple[str, str]]:
    return zip_lines(partition.archive, partition.name)


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Member]:
        return _members(archives(self.options)) or [Member("", "")]

    def read(self, partition: Member) -> Iterator[tuple[str, str]]:
        return _rows(partition) if partition.archive else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"seen": "[]"}

    def latestOffset(self) -> dict:
        return {"seen": json.dumps(archives(self.options))}

    def partitions(self, start: dict, end: dict) -> list[Member]:
        old = set(json.loads(start["seen"]))
        return _members([p for p in json.loads(end["seen"]) if p not in old]) or [Member("", "")]

    def read(self, partition: Member) -> Iterator[tuple[str, str]]:
        return _rows(partition) if partition.archive else iter(())

    def commit(self, end: dict) -> None:
        pass


class ZipFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "source string, line string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def _records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select(F.col("source").alias("_source_file"), F.from_json("line", _with_corrupt(schema), opts).alias("r"))
    return tag_feed_date(parsed.select("r.*", "_source_file"))


def _source(spark: SparkSession, reader, root: str, kind: str | None):
    from inspecta.session import ship_package
    ship_package(spark)
    spark.dataSource.register(ZipFeed)
    prefixes = list(KIND_PREFIX.values()) if kind is None else [KIND_PREFIX[kind]]
    return reader.format(FORMAT).option("path", root).option("prefix", ",".join(prefixes)).load()


def read_zips(spark: SparkSession, root: str, kind: str | None = "delta", schema: T.StructType = VEHICLE) -> DataFrame:
    """Records of the archives under ``root``, columns as of ``read_feed``."""
    return _records(_source(spark, spark.read, root, kind), schema)


def stream_zips(spark: SparkSession, root: str, kind: str | None = "delta", schema: T.StructType = VEHICLE) -> DataFrame:
    """The same as a stream that takes each archive once, for ``ingest``,
    ``start_upsert`` and ``start_log``."""
    return _records(_source(spark, spark.readStream, root, kind), schema)
