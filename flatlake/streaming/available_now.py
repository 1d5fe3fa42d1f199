"""Catch-up ingestion as Structured Streaming queries with ``availableNow``.

``stream_csv_available_now`` is the plain file source: its checkpoint remembers
which files were read, so each run picks up only files that appeared since the
last one, and a file rewritten under its name is not read again.
``stream_ingest`` streams a log of (key, ETag) changes instead and sees both.
"""

from __future__ import annotations

import time
from datetime import date
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.signature import filter_signature, read_signature, run_signature
from ..ingest import RESULT_SCHEMA, _existing_locations, _location_col, _normalize_types, _process_parsed, _type_text
from ..plans import manifest as M
from ..plans.incremental import plan_actions
from ..session import ensure_utc, path_exists, scratch_path
from ..sinks.formats import get_format
from ..sources import catalog as C
from ..sources.csv_scan import typed_value
from ..sources.listing import listing as list_objects, month_dirs


def stream_csv_available_now(
    spark: SparkSession,
    source: str,
    text_schema: T.StructType,
    output: str,
    types: dict[str, T.DataType] | None = None,
    checkpoint: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    path_glob: str = "*/*.csv*",
    output_format: str = "parquet",
) -> None:
    """Process every not-yet-seen CSV file under *source* and stop.

    *text_schema* lists the CSV columns (read as text); *types* converts them
    with the same rules as the batch scan; *transform* is a stateless streaming transformation.
    """
    types = types or {}
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    stream = (
        spark.readStream.schema(text_schema)
        .option("header", True)
        .option("escape", '"')
        .csv(f"{source.rstrip('/')}/{path_glob}")
    )
    typed = stream.select(
        *[typed_value(F.col(f.name), types.get(f.name, T.StringType())).alias(f.name) for f in text_schema.fields]
    )

    out = transform(typed) if transform else typed
    w = out.writeStream.format(output_format).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    # The file sink commits each micro-batch through its metadata log, so a
    # retried batch never duplicates rows (exactly-once output).
    q = w.trigger(availableNow=True).start(output)
    q.awaitTermination()


#: Bytes of a file's head that its header line must fit in.
HEADER_BYTES = 1 << 20
CHANGES = "key string, etag string, size bigint, path string, dataset string, file_date date, filename string, seen bigint"
#: Objects of one file of the change log at most.
LOGGED = 100_000


def record_changes(spark: SparkSession, source_root: str, prefix: str, log: str, per_file: int | None = None) -> int:
    """Append to *log* the dated objects of *prefix* that it does not know, or knows with another ETag; returns how many.

    The newest row of a key in the log is the state a stream has been told of;
    a new or republished object becomes one more row.
    """
    months = month_dirs(spark, source_root, [prefix], date.min, date.max)
    objects = C.build_catalog(list_objects(spark, source_root, months, empty_objects=True)).filter(F.col("dataset") == prefix)
    fresh = objects.select("key", "etag", "size", "path", "dataset", "file_date", "filename").withColumn("seen", F.lit(time.time_ns()))
    if path_exists(spark, log):
        told = spark.read.schema(CHANGES).parquet(log).groupBy("key").agg(F.max_by("etag", "seen").alias("told"))
        fresh = fresh.join(told, "key", "left").filter(~F.col("told").eqNullSafe(F.col("etag"))).drop("told")
    fresh = fresh.persist()
    try:
        many = fresh.count()
        if many:
            fresh.repartition(-(-many // (per_file or LOGGED))).write.mode("append").parquet(log)
        return many
    finally:
        fresh.unpersist()


def stream_ingest(
    spark: SparkSession,
    source_root: str,
    output_root: str,
    dataset: str,
    schema: T.StructType,
    *,
    checkpoint: str | None = None,
    tickers: Sequence[str] = (),
    ticker_prefixes: Sequence[str] = (),
    filter_column: str = "ticker",
    columns: Sequence[str] | None = None,
    timestamp_columns="auto",
    timestamp_unit: str = "ns",
    keep_ns: bool = True,
    output_format: str = "parquet",
    compression="default",
    partition_by: Sequence[str] = ("asset_class", "data_type", "file_date"),
    max_files_per_trigger: int | None = None,
    multi_line: bool = False,
    row_number: str | None = None,
) -> DataFrame:
    """Cron catch-up: ingest every file of *dataset* that is new or was republished since earlier runs, then stop.

    A run first appends the objects whose ETag changed to a log beside the
    checkpoint (:func:`record_changes`); the stream reads that log, so its
    offsets are places in a list of (key, ETag) and a file rewritten under its
    name comes again.  A run that dies leaves its rows in the log for the next.

    *schema* is the typed schema of the files' header (e.g. from
    :func:`flatlake.sources.schema.infer_file_schemas`).  Each micro-batch is a
    batch run over its files: planned against the manifest, staged in one pass,
    files with a bad row, another header or bytes that cannot be decompressed
    reported failed and left out, the others published by dynamic partition
    overwrite with one manifest entry each.  Every file owns its partition
    (``src``, by its key, as in :func:`flatlake.ingest.ingest`), so a retried
    batch rewrites the same files, micro-batches of any size add up to the same
    table, and batch and stream runs may share one.  Objects without a date in
    their name are not data.  Returns the per-file results of this run.
    """
    ensure_utc(spark)
    prefix = C.resolve_dataset(dataset)
    fmt = get_format(output_format)
    codec = fmt.resolve_compression(compression)
    checkpoint = (checkpoint or f"{output_root.rstrip('/')}/_stream_checkpoints/{prefix.replace('/', '__')}").rstrip("/")
    log = f"{checkpoint}_changes"
    types = _normalize_types({f.name: f.dataType for f in schema.fields})
    signature = run_signature(
        fmt.name, codec, filter_signature(filter_column, tickers, ticker_prefixes),
        read_signature(columns, _type_text(types), timestamp_columns, timestamp_unit), None,
        None if row_number is None else {"row_number": row_number},
    )
    results: list[tuple] = []
    if not record_changes(spark, source_root, prefix, log, max_files_per_trigger) and not path_exists(spark, log):
        return spark.createDataFrame(results, RESULT_SCHEMA)

    def process(batch: DataFrame, epoch_id: int) -> None:
        newest = batch.groupBy("key").agg(F.max_by(F.struct("etag", "size", "path", "dataset", "file_date"), "seen").alias("f")).select("key", "f.*")
        current = M.newest_per_key(M.read_current(spark, output_root))
        # the stream has no path template: a file keeps the path that it is known by
        known = newest.join(current.select("key", F.col("rel").alias("known")), "key", "left").withColumn("rel", F.coalesce("known", "key")).drop("known")
        files = known.withColumn("location", _location_col(partition_by)).persist()
        try:
            outputs = files.join(_existing_locations(spark, output_root, files), "location", "left_semi").select("rel")
            plan = plan_actions(files, current, outputs, signature, by="key").collect()
        finally:
            files.unpersist()
        # an output without an entry is left from a batch that died: written again
        todo = [r for r in plan if r.action == "pull" or r.reason == "exists"]
        results.extend((r.key, r.rel, "skipped", None, None, r.reason) for r in plan if r not in todo)
        if not todo:
            return
        outcome = _process_parsed(
            spark, todo, output_root, fmt, codec, None, types, columns, timestamp_columns, timestamp_unit, keep_ns, filter_column, tickers,
            ticker_prefixes, None, partition_by, HEADER_BYTES, None, multi_line, row_number, header=schema.names,
        )
        entries = []
        for r in todo:
            status, rows, error = outcome.get(r.key, ("failed", None, "not processed"))
            results.append((r.key, r.rel, status, rows, error, r.reason))
            if status in ("written", "empty"):
                entries.append((r.rel, r.key, r.etag, int(r.size or 0), rows, signature, fmt.name, status == "written", r.location))
        if entries:
            M.append_entries(spark, output_root, spark.createDataFrame(
                entries,
                "rel string, key string, etag string, size bigint, rows bigint, signature string, "
                "format string, written boolean, location string",
            ), f"stream-{epoch_id}-{M.new_run_id()}")

    changes = spark.readStream.schema(CHANGES)
    if max_files_per_trigger:
        changes = changes.option("maxFilesPerTrigger", 1)  # a file of the log holds at most that many objects
    q = changes.parquet(log).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.createDataFrame(results, RESULT_SCHEMA)
