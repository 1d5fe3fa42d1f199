"""Session construction and shared-storage helpers.

Scratch data (exports, checkpoints, staging) always lives under the shared
folder named by ``spark.checkpoint.dir``.  A folder of our own is only set when
the session has none (local runs and tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "flatlake", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Epoch conversion and ISO rendering assume a UTC session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def bounded_listing(spark: SparkSession):
    """Cap the parallel file-listing job at the cluster's parallelism.

    Reading an explicit list of N files lists each path; above a threshold
    Spark runs a listing job with min(N, 10000) tasks, which for thousands of
    small files costs more than the listing itself.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


@contextmanager
def session_conf(spark: SparkSession, settings: dict):
    """Set SQL confs for the duration of a block, then restore them."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: For partitioned writes: AQE may merge shuffle partitions only down to this
#: size, so thousands of small day partitions are still written by many tasks
#: in parallel; large partitions are governed by the advisory size as usual.
WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024)}


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="flatlake-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/flatlake/{name}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------- #
# Hadoop FileSystem helpers (metadata only: exists, glob, rename, mkdirs).
# They go through the JVM so that every Hadoop scheme (file, hdfs, s3a, ...)
# works the same way Spark's own writers do.
# --------------------------------------------------------------------------- #


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    stats = fs.globStatus(p)
    return [] if stats is None else [str(s.getPath().toString()) for s in stats]


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    return rename_paths(spark, [(src, dst)]) == 1


def rename_paths(spark: SparkSession, pairs) -> int:
    """Metadata-only moves on one FileSystem handle; returns how many succeeded."""
    pairs = list(pairs)
    if not pairs:
        return 0
    fs, _ = _fs(spark, pairs[0][0])
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    made, done = set(), 0
    for src, dst in pairs:
        d = jpath(dst)
        parent = dst.rsplit("/", 1)[0]
        if parent not in made:
            fs.mkdirs(d.getParent())
            made.add(parent)
        done += bool(fs.rename(jpath(src), d))
    return done


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of our own."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty object."""
    fs, p = _fs(spark, path)
    fs.create(p).close()


def file_uri(spark: SparkSession, path: str) -> str:
    """*path* as ``_metadata.file_path`` spells it (URL-encoded where needed)."""
    if re.fullmatch(r"[A-Za-z0-9/_.:=+-]*", path):
        return path
    return str(spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString())


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified URI of *path* (``file:/...`` for local paths)."""
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``flatlake`` importable by Python workers (once per session).

    Functions used in ``mapInPandas``/``mapInArrow`` refer to this package by
    module; a zip of it is added to the job's Python files.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    zip_path = os.path.join(tempfile.mkdtemp(prefix="flatlake-py-"), "flatlake.zip")
    with zipfile.ZipFile(zip_path, "w") as zf:
        for dirpath, _, filenames in os.walk(pkg_dir):
            for f in filenames:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zip_path)
    _SHIPPED.add(key)
