"""Per-file row counts and run outcome counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUSES = ("written", "skipped", "empty", "failed", "planned")


def rows_per_file(df: DataFrame, key_col: str = "key") -> DataFrame:
    """``(key, rows)``: rows kept per source file (partial counts before the shuffle)."""
    return df.groupBy(key_col).agg(F.count(F.lit(1)).alias("rows"))


def status_counts(result: DataFrame, status_col: str = "status") -> DataFrame:
    """``(status, files)`` of a run result."""
    return result.groupBy(status_col).agg(F.count(F.lit(1)).alias("files"))


def run_ok(result: DataFrame) -> bool:
    """A run is ok when no file failed."""
    return result.filter(F.col("status") == "failed").limit(1).count() == 0
