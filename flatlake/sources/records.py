"""CSV records over many tasks: line ends inside quotes, and every row's number in its file.

A file of a splittable kind (plain, bz2) is read by one task per split, line by
line.  Whether a line continues a record depends on all quotes before it:

1. One pass counts per split whether its quotes are odd, and how many records
   start in it if it begins outside or inside quotes.
2. A running sum over the splits of a file says which splits begin inside
   quotes and how many records start before each (one small row a split).
3. The second pass joins lines to records within each split.  What is left at
   the edges (a record begun before the split or not finished in it) are at
   most two fragments a split; those of one record are put together by file.

A record's number counts the records of its file from 0, the header.  Quotes
are counted as RFC 4180 writes them: a quoted field doubles its own.  A file
whose last quote never closes ends in a record marked as not whole.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bounded_listing

RECORDS = "path string, split bigint, number bigint, part string, record string"


def file_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, split, line)`` in the order of the file within each split."""
    with bounded_listing(spark):
        lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.make_valid_utf8("value").alias("line"))


def _runs(batch: pa.RecordBatch):
    """``(path, split, lines)`` of every run of rows from one split."""
    path, split = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
    if not len(split):
        return
    code = path.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(split) != 0)) + 1
    edges = [0, *cut.tolist(), len(split)]
    for i, j in zip(edges[:-1], edges[1:]):
        yield path[i].as_py(), int(split[i]), batch.column(2).slice(i, j - i)


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _blank(lines: pa.Array) -> np.ndarray:
    return pc.equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)


def split_counts(lines: DataFrame) -> DataFrame:
    """Per split: odd quotes, and records that start in it by the state it begins in."""

    def run(batches):
        here, odd, starts = None, 0, [0, 0]

        def row():
            return pa.RecordBatch.from_pydict({"path": [here[0]], "split": [here[1]], "odd": [odd], "if_closed": [starts[0]], "if_open": [starts[1]]})

        for batch in batches:
            for path, split, part in _runs(batch):
                if here != (path, split):
                    if here:
                        yield row()
                    here, odd, starts = (path, split), 0, [0, 0]
                quotes = _quotes(part)
                before = (odd + np.cumsum(quotes) - quotes) & 1
                filled = ~_blank(part)
                starts = [starts[k] + int((filled & (before == k)).sum()) for k in (0, 1)]
                odd = (odd + int(quotes.sum())) & 1
        if here:
            yield row()

    return lines.mapInArrow(run, "path string, split bigint, odd bigint, if_closed bigint, if_open bigint")


def split_states(lines: DataFrame) -> DataFrame:
    """``(path, split, open, first, odd)``: whether each split begins inside quotes, and the number of its first record."""
    counts = split_counts(lines)
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    state = counts.withColumn("open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("open") == 1, F.col("if_open")).otherwise(F.col("if_closed"))
    return state.withColumn("first", F.coalesce(F.sum(starts).over(earlier), F.lit(0))).select("path", "split", "open", "first", "odd")


def _joined(sent):
    """Records of every split; ``part``: w(hole), or a fragment: t (begun here), m (in the midst), h (finished here)."""

    def run(batches):
        states = sent.value
        here, inside, number, pending, begun, head = None, 0, 0, [], 0, False

        def out(numbers, parts, records):
            n = len(numbers)
            columns = [pa.array([here[0]] * n), pa.array([here[1]] * n, pa.int64()), pa.array(numbers, pa.int64()), pa.array(parts, pa.string()), records]
            return pa.RecordBatch.from_arrays(columns, names=["path", "split", "number", "part", "record"])

        def left():
            return out([begun], ["m" if head else "t"], pa.array(["\n".join(pending)], pa.string()))

        for batch in batches:
            for path, split, lines in _runs(batch):
                if here != (path, split):
                    if pending:
                        yield left()
                    here = (path, split)
                    inside, number = states[here]
                    pending, head = [], bool(inside)
                after = inside + np.cumsum(quotes := _quotes(lines))
                before = (after - quotes) & 1
                starts = (before == 0) & ~_blank(lines)
                numbers = number + np.cumsum(starts) - 1
                simple = starts & (after & 1 == 0)
                if simple.any():
                    rows = lines.filter(pa.array(simple))
                    if pc.any(pc.ends_with(rows, "\r")).as_py():
                        rows = pc.replace_substring_regex(rows, "\r$", "")
                    yield out(numbers[simple], ["w"] * len(rows), rows.cast(pa.string()))
                found = [], [], []
                for i in np.flatnonzero((before == 1) | (after & 1 == 1)).tolist():
                    line = lines[i].as_py()
                    if not before[i]:
                        pending, begun = [line], int(numbers[i])
                    else:
                        pending.append(line)
                    if after[i] % 2 == 0:
                        for column, value in zip(found, (begun, "h" if head else "w", "\n".join(pending).removesuffix("\r"))):
                            column.append(value)
                        pending, head = [], False
                if found[0]:
                    yield out(found[0], found[1], pa.array(found[2], pa.string()))
                inside, number = int(after[-1]) & 1, int(numbers[-1]) + 1
        if pending:
            yield left()

    return run


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, number, record, whole)`` of all records of the files, the header being number 0; blank lines are no records.

    Files without a record over the edge of a split are read in the two passes;
    if there is one, a third pass collects the fragments.
    """
    lines = file_lines(spark, paths)
    # one row a split, like the file listing that the driver holds for the scan anyway
    states = split_states(lines).collect()
    sent = spark.sparkContext.broadcast({(r["path"], r["split"]): (r["open"], r["first"]) for r in states})
    parts = lines.mapInArrow(_joined(sent), RECORDS)
    records = parts.filter("part = 'w'").select("path", "number", "record", F.lit(True).alias("whole"))
    unclosed: dict[str, int] = {}
    for r in states:
        unclosed[r["path"]] = unclosed.get(r["path"], 0) ^ r["odd"]
    if not any(r["open"] for r in states) and not any(unclosed.values()):
        return records
    # at most two fragments a split: what ends a record comes before what begins the next
    along = Window.partitionBy("path").orderBy("split", F.expr("part = 't'"))
    chained = parts.filter("part != 'w'").withColumn("chain", F.sum(F.expr("cast(part = 't' as int)")).over(along))
    pieces = F.array_sort(F.collect_list(F.struct("split", "record")))
    glued = chained.groupBy("path", "chain").agg(
        F.max(F.when(F.col("part") == "t", F.col("number"))).alias("number"), pieces.alias("pieces"), F.max(F.col("part") == "h").alias("whole"),
    )
    return records.unionByName(glued.select("path", "number", F.array_join(F.col("pieces.record"), "\n").alias("record"), "whole"))


def record_columns(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], options: dict, bad: str, path: str, number: str) -> DataFrame:
    """Columns of the records as text, with the malformed record in *bad*, the file in *path* and the row in *number* (from 0)."""
    rows = csv_records(spark, paths).filter("number > 0")
    fields = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*columns, bad])
    parsed = rows.select(
        F.from_csv("record", fields, {**options, "columnNameOfCorruptRecord": bad}).alias("v"),
        F.when(~F.col("whole"), F.col("record")).alias("unclosed"), F.col("path").alias(path), (F.col("number") - 1).alias(number),
    )
    names = [F.col("v").getField(n).alias(n) for n in columns]
    return parsed.select(*names, F.coalesce(F.col("v").getField(bad), "unclosed").alias(bad), path, number)
