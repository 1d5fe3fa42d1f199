"""Provenance manifest: which source object and settings produced each output.

Stored as an append-only Parquet log under ``<output_root>/_manifest`` (the
leading underscore hides it from readers of the output table).  Every run
appends its entries; forgetting a path appends a tombstone.  The current
state is the newest row per ``rel``; a window over ``rel`` only ever sees one
row per run, so it stays small however large the table grows.

Compaction writes a snapshot generation: the current rows and the names of the
log files they cover.  Readers take the newest complete snapshot and the log
files it does not cover, so the live log is never moved or rewritten, an entry
appended meanwhile stays, and a crash leaves the generation before.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import glob_paths

MANIFEST_DIR = "_manifest"
MANIFEST_SCHEMA = (
    "rel string, key string, etag string, size bigint, rows bigint, signature string, "
    "format string, written boolean, completed_at timestamp, location string, "
    "run_id string, op string"
)
ENTRY_COLUMNS = [
    "rel", "key", "etag", "size", "rows", "signature", "format", "written", "completed_at", "location",
]


def manifest_path(output_root: str) -> str:
    return output_root.rstrip("/") + "/" + MANIFEST_DIR


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)


SNAPSHOT_DIR = "_manifest_snapshots"


def _log_files(spark: SparkSession, output_root: str) -> list[str]:
    return sorted(glob_paths(spark, manifest_path(output_root) + "/*.parquet"))


def _snapshot(spark: SparkSession, output_root: str) -> tuple[str | None, set[str]]:
    """Newest complete snapshot and the names of the log files it covers."""
    done = sorted(glob_paths(spark, f"{output_root.rstrip('/')}/{SNAPSHOT_DIR}/*/covered/_SUCCESS"))
    if not done:
        return None, set()
    folder = done[-1].removesuffix("/covered/_SUCCESS")
    return folder, {r[0] for r in spark.read.parquet(f"{folder}/covered").collect()}


def _uncovered(spark: SparkSession, output_root: str, covered: set[str]) -> list[str]:
    return [f for f in _log_files(spark, output_root) if f.rsplit("/", 1)[-1] not in covered]


def log_files_to_read(spark: SparkSession, output_root: str) -> int:
    return len(_uncovered(spark, output_root, _snapshot(spark, output_root)[1]))


def read_log(spark: SparkSession, output_root: str) -> DataFrame:
    """Newest snapshot and the log files after it; empty when absent.  A log that cannot be read raises."""
    folder, covered = _snapshot(spark, output_root)
    files = _uncovered(spark, output_root, covered)
    frames = [spark.read.schema(MANIFEST_SCHEMA).parquet(*x) for x in ([f"{folder}/entries"] if folder else [], files) if x]
    if not frames:
        return empty_log(spark)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def current_entries(log: DataFrame) -> DataFrame:
    """Newest row per ``rel`` (by ``completed_at``, then ``run_id``); tombstones removed."""
    w = Window.partitionBy("rel").orderBy(F.col("completed_at").desc(), F.col("run_id").desc())
    return (
        log.withColumn("_rn", F.row_number().over(w))
        .filter((F.col("_rn") == 1) & (F.col("op") == "record"))
        .drop("_rn", "op")
    )


def read_current(spark: SparkSession, output_root: str) -> DataFrame:
    return current_entries(read_log(spark, output_root))


def newest_per_key(entries: DataFrame) -> DataFrame:
    """Of current entries, the newest of each source key, whatever path it was rendered to."""
    w = Window.partitionBy("key").orderBy(F.col("completed_at").desc(), F.col("run_id").desc(), F.col("rel").desc())
    return entries.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def append_entries(spark: SparkSession, output_root: str, entries: DataFrame, run_id: str) -> None:
    """Append ``ENTRY_COLUMNS`` rows as one run (one Spark commit)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = entries.select(
        *[c for c in ENTRY_COLUMNS if c != "completed_at"],
        F.coalesce(F.col("completed_at"), F.lit(now).cast("timestamp")).alias("completed_at")
        if "completed_at" in entries.columns
        else F.lit(now).cast("timestamp").alias("completed_at"),
    )
    (
        rows.withColumn("run_id", F.lit(run_id)).withColumn("op", F.lit("record"))
        .select(*[f.split(" ")[0] for f in MANIFEST_SCHEMA.split(", ")])
        .coalesce(1)
        .write.mode("append")
        .parquet(manifest_path(output_root))
    )


def forget(spark: SparkSession, output_root: str, rels: Iterable[str]) -> None:
    """Append tombstones: the paths are treated as never written."""
    run_id = new_run_id()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(r, None, None, None, None, None, None, None, now, None, run_id, "forget") for r in rels]
    if rows:
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(
            manifest_path(output_root)
        )


def compact(spark: SparkSession, output_root: str) -> int:
    """Write a snapshot of the current view (one row per live ``rel``); returns its number of entries."""
    files = _log_files(spark, output_root)
    if not files:
        return 0
    folder, covered = _snapshot(spark, output_root)
    names = [f.rsplit("/", 1)[-1] for f in files]
    fresh = [f for f, n in zip(files, names) if n not in covered]
    log = [spark.read.schema(MANIFEST_SCHEMA).parquet(*x) for x in ([f"{folder}/entries"] if folder else [], fresh) if x]
    live = current_entries(log[0] if len(log) == 1 else log[0].unionByName(log[1])).withColumn("op", F.lit("record"))
    target = f"{output_root.rstrip('/')}/{SNAPSHOT_DIR}/{new_run_id()}"
    live.select(*[f.split(" ")[0] for f in MANIFEST_SCHEMA.split(", ")]).write.mode("error").parquet(f"{target}/entries")
    # the list of covered files is written last: with its _SUCCESS the snapshot counts
    spark.createDataFrame([(n,) for n in names], "file string").write.mode("error").parquet(f"{target}/covered")
    return spark.read.parquet(f"{target}/entries").count()
