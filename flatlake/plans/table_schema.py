"""Types of published tables across runs.

A run infers types from its own files, so a column may be whole numbers one
night and fractions the next.  The types of each dataset's table are kept under
``<output_root>/_table_schemas/<dataset>/`` (one JSON file per change, the last
by name is current).  A run publishes under the widened types; if an older type
widens, the dataset's earlier partitions are rewritten once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.union import widen_type
from ..session import delete_path, glob_paths, scratch_path
from .manifest import new_run_id

SCHEMA_DIR = "_table_schemas"
#: Formats whose files carry types; text formats read back as text.
TYPED = ("parquet", "feather")


def _folder(output_root: str, dataset: str) -> str:
    return f"{output_root.rstrip('/')}/{SCHEMA_DIR}/{dataset.replace('/', '__')}"


def stored_schema(spark: SparkSession, output_root: str, dataset: str) -> T.StructType | None:
    files = sorted(glob_paths(spark, f"{_folder(output_root, dataset)}/v-*/part-*"))
    if not files:
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(files[-1], wholetext=True).first()[0]))


def store_schema(spark: SparkSession, output_root: str, dataset: str, schema: T.StructType) -> None:
    one = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
    one.write.text(f"{_folder(output_root, dataset)}/v-{new_run_id()}")


def widened(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Columns of both, old ones first, each with the wider type."""
    if old is None:
        return new
    fresh = {f.name: f.dataType for f in new.fields}
    both = [T.StructField(f.name, widen_type(f.dataType, fresh[f.name]) if f.name in fresh else f.dataType) for f in old.fields]
    return T.StructType(both + [f for f in new.fields if f.name not in old.names])


def cast_to(df: DataFrame, schema: T.StructType, partitions) -> DataFrame:
    have = set(df.columns)
    cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *partitions)


def fit_table(spark, output_root: str, dataset: str, df: DataFrame, fmt, codec, partitions, options=None) -> DataFrame:
    """*df* under the dataset's table types, after earlier partitions were brought to them."""
    if fmt.name not in TYPED:
        return df
    own = T.StructType([f for f in df.schema.fields if f.name not in partitions])
    old = stored_schema(spark, output_root, dataset)
    target = widened(old, own)
    if old is None or target != old:
        changed = old is not None and any(f.dataType != target[f.name].dataType for f in old.fields)
        if changed:
            _rewrite(spark, output_root, dataset, old, target, fmt, codec, partitions, options)
        store_schema(spark, output_root, dataset, target)
    return cast_to(df, target, partitions)


def _rewrite(spark, output_root, dataset, old, target, fmt, codec, partitions, options) -> None:
    """Cast the published partitions of *dataset* to *target*: staged first, then overwritten one by one."""
    from .manifest import read_current
    from ..sinks.formats import read_output

    current = read_current(spark, output_root).filter(F.col("written") & F.col("location").isNotNull())
    here = [r[0] for r in current.filter(F.col("key").startswith(dataset + "/")).select("location").distinct().collect()]
    root = output_root.rstrip("/")
    folders = [f"{root}/{x}" for x in here if glob_paths(spark, f"{root}/{x}")]
    if not folders:
        return
    kinds = T.StructType([*old.fields, *(T.StructField(p, T.StringType()) for p in partitions)])
    if fmt.name == "parquet":
        rows = spark.read.schema(kinds).option("basePath", root).parquet(*folders)
    else:
        rows = read_output(spark, fmt.name, root)
    stage = scratch_path(spark, "retyped")
    cast_to(rows, target, partitions).write.parquet(stage)
    fmt.write(spark.read.parquet(stage), root, codec, partitions, options)
    delete_path(spark, stage)
