"""Object listings as DataFrames.

``listing(key, etag, size, last_modified, path)``: one row per object under a
root.  The default reader is Spark's ``binaryFile`` source with the content
column pruned away, so only file metadata is listed (Spark parallelises large
listings over the cluster).  Object stores that expose ETags can supply their
own listing frame with the same columns.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import dataset_of_key, unquote_etag
from ..session import bounded_listing, glob_paths, path_exists, qualify

LISTING_SCHEMA = "key string, etag string, size bigint, last_modified timestamp, path string"


def empty_listing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LISTING_SCHEMA)


def _empty_objects(spark: SparkSession, folders: Sequence[str], skip: int) -> list[tuple]:
    """Zero-byte objects directly in *folders*, which Spark's file sources leave out (one listing call per folder)."""
    jvm, rows = spark._jvm, []
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        for m in _EMPTY.finditer(jvm.scala.runtime.ScalaRunTime.stringOf(statuses)):
            rows.append((m["path"][skip:], f"0-{int(m['time']) * 1000}", 0, m["path"]))
    return rows


_EMPTY = re.compile(r"path=(?P<path>[^;]*); isDirectory=false; length=0; [^}]*?modification_time=(?P<time>\d+)")


def listing(spark: SparkSession, root: str, prefixes: Sequence[str] | None = None, empty_objects: bool = False) -> DataFrame:
    """List every object under *root* (or under ``root/<prefix>`` for each prefix;
    an empty prefix list lists nothing).  Zero-byte objects are listed only with
    *empty_objects*, directly in the given prefixes.

    The ETag stand-in is ``<size>-<mtime micros>``: it changes whenever an
    object is rewritten, which is what the incremental plan needs.
    """
    qroot = qualify(spark, root).rstrip("/")
    if prefixes is None:
        targets = [qroot]
    else:
        targets = [f"{qroot}/{p.strip('/')}" for p in prefixes]
    targets = [t for t in targets if path_exists(spark, t)]
    if not targets:
        return empty_listing(spark)
    with bounded_listing(spark):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(targets)
            .select("path", "length", "modificationTime")
        )
    key = F.substr(F.col("path"), F.lit(len(qroot) + 2))
    found = files.select(
        key.alias("key"),
        unquote_etag(F.concat_ws("-", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))).alias("etag"),
        F.coalesce(F.col("length"), F.lit(0)).cast("bigint").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        F.col("path"),
    )
    blank = _empty_objects(spark, targets, len(qroot) + 1) if empty_objects else []
    if not blank:
        return found
    extra = spark.createDataFrame(blank, "key string, etag string, size bigint, path string")
    return found.unionByName(extra.withColumn("last_modified", F.timestamp_micros(F.substring_index("etag", "-", -1).cast("bigint"))))


def list_keys(listing_df: DataFrame, prefix: str) -> DataFrame:
    """Keys under *prefix* (a directory: a trailing ``/`` is implied), sorted."""
    p = prefix.rstrip("/") + "/"
    return listing_df.filter(F.col("key").startswith(p)).select("key").orderBy("key")


def list_prefixes(listing_df: DataFrame) -> DataFrame:
    """Distinct ``asset_class/data_type`` prefixes, sorted."""
    return (
        listing_df.select(dataset_of_key("key").alias("prefix"))
        .filter(F.col("prefix").isNotNull())
        .distinct()
        .orderBy("prefix")
    )


def month_dirs(spark: SparkSession, root: str, prefixes: Sequence[str], first, last) -> list[str]:
    """``<prefix>/YYYY/MM`` directories under *root* whose month lies in ``[first, last]``.

    One glob per dataset (directory metadata only), so a date-range or
    newest-N selection lists just the months it can select from instead of a
    dataset's whole history.
    """
    qroot = qualify(spark, root).rstrip("/")
    lo, hi = (first.year, first.month), (last.year, last.month)
    out = []
    for prefix in prefixes:
        base = f"{qroot}/{prefix.strip('/')}"
        for p in glob_paths(spark, f"{base}/[0-9][0-9][0-9][0-9]/[0-9][0-9]"):
            rel = p[len(base) + 1:] if p.startswith(base + "/") else None
            if rel is None:
                continue
            y, m = rel.split("/")
            if lo <= (int(y), int(m)) <= hi:
                out.append(f"{prefix.strip('/')}/{y}/{m}")
    return sorted(out)
