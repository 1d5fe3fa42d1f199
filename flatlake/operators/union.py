"""Union of per-file or per-dataset frames with schema widening.

Each source file gets its own inferred schema; a table needs one.  Types widen
along integer -> double -> string (any other disagreement becomes string) and
columns missing from a frame are NULL.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def widen_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return T.LongType()
    if isinstance(a, _INTEGRAL + _FRACTIONAL) and isinstance(b, _INTEGRAL + _FRACTIONAL):
        return T.DoubleType()
    if isinstance(a, (T.TimestampType, T.TimestampNTZType)) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampType()
    return T.StringType()


def widen_schemas(schemas: Sequence[T.StructType]) -> T.StructType:
    """Column order of first appearance; types widened pairwise."""
    order: list[str] = []
    types: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            if f.name not in types:
                order.append(f.name)
                types[f.name] = f.dataType
            else:
                types[f.name] = widen_type(types[f.name], f.dataType)
    return T.StructType([T.StructField(n, types[n], True) for n in order])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast/extend *df* to *schema* (missing columns NULL)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """``unionByName`` after widening every frame to the common schema."""
    if not frames:
        raise ValueError("nothing to union")
    schema = widen_schemas([f.schema for f in frames])
    return reduce(lambda a, b: a.unionByName(b), [conform(f, schema) for f in frames])
