"""Incremental planning: which selected files must be (re)ingested.

One relational query: selected files LEFT JOIN current manifest entries LEFT
JOIN existing outputs on ``rel``, then a CASE:

* force                                           -> pull  (force)
* entry, but ETag, signature or path differs      -> pull  (changed)
* entry current, and not written or output exists -> skip  (up to date)
* entry current, written, output gone             -> pull  (output missing)
* no entry, output exists                         -> skip  (exists)
* otherwise                                       -> pull  (new)

Both sides are file metadata (one row per file), so the joins are cheap; AQE
picks broadcast when a side is small.  In ``ingest`` every source file owns its
output location, so files are skipped, rewritten and failed one by one; a table
whose partitions hold several files can pass ``group_cols`` to pull a partition
as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def plan_actions(
    files: DataFrame,
    current: DataFrame,
    outputs: DataFrame,
    signature,
    force: bool = False,
    group_cols: list[str] | None = None,
    by: str = "rel",
) -> DataFrame:
    """Add ``action`` (pull/skip) and ``reason`` to *files* (which carry ``rel``, ``etag``).

    *current*: manifest entries (``rel, etag, signature, written``).
    *outputs*: ``rel`` of outputs that exist.
    *signature*: the run's signature (str) or a Column.
    *group_cols*: physical partition columns; when set, any pull in a group
    pulls the whole group.
    *by*: what names a file in the manifest: its rendered path, or its ``key``
    (*current* then has one entry a key); a new path is a change then.
    """
    sig = F.lit(signature) if isinstance(signature, str) else signature
    m = current.select(
        by,
        *([F.col("rel").alias("_m_rel")] if by != "rel" else []),
        F.col("etag").alias("_m_etag"),
        F.col("signature").alias("_m_sig"),
        F.col("written").alias("_m_written"),
        F.lit(True).alias("_m_has"),
    )
    o = outputs.select("rel", F.lit(True).alias("_exists")).distinct()
    j = files.join(m, by, "left").join(o, "rel", "left")
    has = F.coalesce(F.col("_m_has"), F.lit(False))
    exists = F.coalesce(F.col("_exists"), F.lit(False))
    current_ok = has & (F.col("_m_etag") == F.col("etag")) & (F.col("_m_sig") == sig)
    if by != "rel":
        current_ok &= F.col("_m_rel") == F.col("rel")
    written = F.coalesce(F.col("_m_written"), F.lit(False))
    reason = (
        F.when(F.lit(force), F.lit("force"))
        .when(has & ~F.coalesce(current_ok, F.lit(False)), F.lit("changed"))
        .when(has & (~written | exists), F.lit("up to date"))
        .when(has, F.lit("output missing"))
        .when(exists, F.lit("exists"))
        .otherwise(F.lit("new"))
    )
    action = F.when(reason.isin("up to date", "exists"), F.lit("skip")).otherwise(F.lit("pull"))
    planned = j.withColumn("reason", reason).withColumn("action", action)
    if group_cols:
        w = Window.partitionBy(*group_cols)
        any_pull = F.max((F.col("action") == "pull").cast("int")).over(w) == 1
        planned = planned.withColumn(
            "reason", F.when((F.col("action") == "skip") & any_pull, F.lit("partition rewrite")).otherwise(F.col("reason"))
        ).withColumn("action", F.when(any_pull, F.lit("pull")).otherwise(F.col("action")))
    return planned.drop("_m_rel", "_m_etag", "_m_sig", "_m_written", "_m_has", "_exists")


def new_files(files: DataFrame, current: DataFrame) -> DataFrame:
    """Files with no manifest entry at all (left anti join on ``rel``)."""
    return files.join(current.select("rel"), "rel", "left_anti")


def duplicate_rels(files: DataFrame) -> DataFrame:
    """``rel`` values rendered by more than one source file (must be empty)."""
    return files.groupBy("rel").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
