"""Flat-file CSV scan: all-string PERMISSIVE read, then typed, validated casts.

Reading every column as text and casting with ``try_cast`` lets one scan both
produce typed rows and flag, per row, whether any value did not fit the
file's schema (or the row was malformed).  The flag is what isolates a bad
file: its key is dropped before publishing, the other files go through.

Line ends inside quotes and row numbers go through :mod:`.records`, which keeps
plain and bz2 files split over several tasks.

Gzip is not splittable: each ``.gz`` file is one scan task.  Later stages
(filters, writes) run on whatever partitioning follows; ``repartition`` after
the scan spreads the work of a few huge files.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FALSE_TOKENS, NULL_TOKENS, TRUE_TOKENS
from ..session import bounded_listing
from .records import record_columns
from .schema import CSV_OPTIONS, FLOAT_PATTERN, INT_PATTERN, compression_for_name

BAD_COL = "_bad"
ROW_BAD = "_row_bad"
PATH_COL = "_path"
NUMBER_COL = "_number"

_SPARK_CODECS = {None, "gzip", "bz2", "zstd"}


def check_codec(path: str) -> None:
    codec = compression_for_name(path)
    if codec not in _SPARK_CODECS:
        raise ValueError(f"{codec} compressed source files are not readable by Spark: {path}")


def string_schema(columns: Sequence[str]) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    return T.StructType(fields + [T.StructField(BAD_COL, T.StringType(), True)])


def read_text_columns(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], multi_line: bool = False, number: str | None = None) -> DataFrame:
    """All-string scan of files sharing one header, plus ``_bad`` and ``_path``.

    With *multi_line* quoted fields may hold line ends; with *number* the rows'
    places in their files (from 0) are a column of that name.
    """
    for p in paths:
        check_codec(p)
    if multi_line or number:
        rows = record_columns(spark, paths, columns, CSV_OPTIONS, BAD_COL, PATH_COL, number or NUMBER_COL)
        return rows if number else rows.drop(NUMBER_COL)
    reader = (
        spark.read.schema(string_schema(columns))
        .option("header", True)
        .options(**CSV_OPTIONS)
        .option("columnNameOfCorruptRecord", BAD_COL)
    )
    with bounded_listing(spark):
        df = reader.csv(list(paths))
    return df.withColumn(PATH_COL, F.col("_metadata.file_path"))


def typed_value(raw: Column, dtype: T.DataType) -> Column:
    """Text -> *dtype*; NULL when the text is a null token or does not fit."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(raw, F.lit(""))
    v = F.when(raw.isNull() | raw.isin(list(NULL_TOKENS)), F.lit(None).cast("string")).otherwise(raw)
    if isinstance(dtype, T.BooleanType):
        return F.when(v.isin(list(TRUE_TOKENS)), F.lit(True)).when(v.isin(list(FALSE_TOKENS)), F.lit(False))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.when(v.rlike(INT_PATTERN), v.try_cast(dtype))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(v.rlike(FLOAT_PATTERN), v.try_cast(dtype))
    if isinstance(dtype, T.DateType):
        return F.try_to_date(v, "yyyy-MM-dd")
    if isinstance(dtype, T.BinaryType):
        return F.encode(v, "UTF-8")
    if isinstance(dtype, T.DecimalType) and dtype.scale == 0:
        return F.when(v.rlike(INT_PATTERN), v.try_cast(dtype))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # microseconds are all a Spark timestamp holds: a finer non-zero fraction does not fit
        return F.when(~v.rlike(r"[.][0-9]{6}[0-9]*[1-9]"), v.try_cast(dtype))
    return v.try_cast(dtype)


def value_misfit(raw: Column, typed: Column, dtype: T.DataType, most: int | None = None) -> Column:
    """True when a non-null text did not convert, or lies outside ``[0, most]`` of an unsigned type."""
    if isinstance(dtype, T.StringType):
        return F.lit(False)
    misfit = raw.isNotNull() & ~raw.isin(list(NULL_TOKENS)) & typed.isNull()
    if most is None:
        return misfit
    return misfit | F.coalesce((typed < 0) | (typed > F.lit(most).cast("decimal(20,0)")), F.lit(False))


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def apply_schema(df: DataFrame, schema: T.StructType, keep: Sequence[str] | None = None, limits: dict[str, int] | None = None, more: Sequence[str] = ()) -> DataFrame:
    """Typed columns of *schema* (restricted to *keep*), the columns *more* as they are, ``_row_bad``, ``_path``.

    *limits* are the largest values of unsigned columns.

    Only kept columns are converted and checked, like a parse that includes
    just those columns; a malformed row (wrong field count) is always bad.
    """
    names = [f.name for f in schema.fields if keep is None or f.name in keep]
    if keep is not None:
        missing = [c for c in keep if c not in schema.names]
        if missing:
            raise KeyError(f"Column(s) {missing} not found in file columns {schema.names}")
        names = [c for c in keep]
    typed, misfits = [], [F.col(BAD_COL).isNotNull()]
    for n in names:
        dt = schema[n].dataType
        t = typed_value(quoted(n), dt)
        typed.append(t.alias(n))
        misfits.append(value_misfit(quoted(n), t, dt, (limits or {}).get(n)))
    row_bad = reduce(lambda a, b: a | b, misfits)
    return df.select(*typed, *map(quoted, more), row_bad.alias(ROW_BAD), F.col(PATH_COL))


def scan_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    limits: dict[str, int] | None = None,
    number: str | None = None,
) -> DataFrame:
    """Typed scan of files sharing one header; rows carry ``_row_bad`` and ``_path``, and their *number* in the file if named."""
    if number in schema.names:
        raise ValueError(f"the files have a column {number!r}; name the row numbers otherwise")
    raw = read_text_columns(spark, paths, schema.names, multi_line, number)
    return apply_schema(raw, schema, columns, limits, [number] if number else ())
