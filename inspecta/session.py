"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Time zone is fixed so DATE(ts) means the
# same day on every executor; timestamps in this package are wall-clock
# (timestamp_ntz) anyway.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "inspecta", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only where it is unset on a local master (tests) a private
    temporary folder is created and registered; on a cluster an unset folder
    is an error, since executors could not read each other's files.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            base = None
    if not base and sc.getCheckpointDir():
        base = sc.getCheckpointDir().rsplit("/", 1)[0]   # Spark adds a folder of its own
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="inspecta-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) by the session's Hadoop configuration, for any scheme Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/inspecta/{name}-{uuid.uuid4().hex[:12]}"


# Suggested settings for a large cluster (about 100 TB input, ~1000 executors).
# Shuffle partitions start high and AQE coalesces them to ~256 MB each; skewed
# sort-merge joins are split; explicit broadcasts in this package are all
# size-checked, so the automatic threshold stays modest.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxRecordsPerFile": "5000000",
    "spark.ui.enabled": "false",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``inspecta`` importable in Python workers (once per application).

    Grouped-map and map-in-pandas functions are unpickled on the executors,
    which import this package.  When it is not installed there (e.g. the
    job was started from another directory), the package is zipped and
    added with ``addPyFile``, Spark's way of shipping code to executors.
    """
    import os
    import shutil

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="inspecta-pyfiles-")  # code artifact on the driver
    archive = shutil.make_archive(os.path.join(out_dir, "inspecta"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="inspecta")
    sc.addPyFile(archive)
    _SHIPPED.add(app)
