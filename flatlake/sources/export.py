"""Write a DataFrame as dated flat files in the bucket layout.

``<root>/<asset_class>/<data_type>/<YYYY>/<MM>/<YYYY-MM-DD>.csv.gz`` — the
shape the ingest side reads.  Spark writes one gzip CSV per task and
(dataset, day) with ``partitionBy``; the files are then renamed into the key
layout (metadata-only moves).  No shuffle is forced, so a hot day is never
funnelled into one task: a day written by several tasks becomes several
files, ``YYYY-MM-DD.csv.gz``, ``YYYY-MM-DD.p00001.csv.gz``, ...
"""

from __future__ import annotations

import re
from collections import defaultdict
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.epoch import stringify_timestamps
from ..session import WRITE_CONF, glob_paths, qualify, rename_paths, scratch_path, session_conf

_PART = re.compile(r"/dataset=([^/]+)/file_date=([0-9]{4})-([0-9]{2})-([0-9]{2})/(part-[^/]+)$")


def export_daily_files(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    columns: Sequence[str],
    dataset_col: str = "dataset",
    date_col: str = "file_date",
    suffix: str = "",
    split: bool = True,
) -> list[str]:
    """Export *rows* (with ``dataset`` and ``file_date`` columns) as daily gzip CSVs.

    *suffix* goes into the file names, for several exports of the same days.
    Returns the object keys written (relative to *root*).
    """
    stage = scratch_path(spark, "export-stage")
    data = stringify_timestamps(rows.select(*columns, F.col(dataset_col).alias("dataset"), F.col(date_col).cast("date").alias("file_date")))
    with session_conf(spark, WRITE_CONF):
        # rebalancing splits a large day over several files; without it a day
        # that the caller has put into one partition is one file
        (
            (data.hint("rebalance", "dataset", "file_date") if split else data)
            .write.partitionBy("dataset", "file_date")
            .option("header", True)
            .option("escape", '"')
            .option("compression", "gzip")
            .csv(stage)
        )
    qroot = qualify(spark, root).rstrip("/")
    parts = sorted(glob_paths(spark, qualify(spark, stage) + "/dataset=*/file_date=*/part-*"))
    seq: dict[tuple, int] = defaultdict(int)
    keys, moves = [], []
    for p in parts:
        m = _PART.search(p)
        if not m:
            continue
        ds, y, mo, d, _ = m.groups()
        ds = unquote(ds)
        n = seq[(ds, y, mo, d)]
        seq[(ds, y, mo, d)] += 1
        name = f"{y}-{mo}-{d}{suffix}.csv.gz" if n == 0 else f"{y}-{mo}-{d}{suffix}.p{n:05d}.csv.gz"
        key = f"{ds}/{y}/{mo}/{name}"
        moves.append((p, f"{qroot}/{key}"))
        keys.append(key)
    rename_paths(spark, moves)
    return keys
