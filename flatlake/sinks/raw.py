"""Byte-for-byte copies of source objects, as a distributed job.

One row per file ``(key, path, dest)``; ``mapInPandas`` copies each file in
1 MiB chunks through ``pyarrow.fs`` (never holding a file in memory) into a
task-attempt temp name, then renames it into place, so a retried task never
leaves a half-written file.  Returns ``(key, dest, bytes, md5)`` per file.

A file larger than PART_BYTES that goes to a file system with positional writes
(a mounted one) is copied by ranges, each a task's work: every range is written
to its own place in one temp file and reported with its digest; once all ranges
of a file are there, a second job renames it.  Its ``md5`` is that of the
ranges' digests, a dash and their number.  Arrow's object stores have no
positional writes: there a file is one task.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path

CHUNK = 1 << 20
#: Larger files are copied in ranges of this many bytes.
PART_BYTES = 256 << 20
RESULT_SCHEMA = "key string, dest string, bytes long, md5 string, error string"


def _fs_path(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        local = path[5:]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    uri = "s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path
    return pafs.FileSystem.from_uri(uri)


def copy_file(src: str, dest: str) -> tuple[int, str]:
    sfs, sp = _fs_path(src)
    dfs, dp = _fs_path(dest)
    parent = dp.rsplit("/", 1)[0]
    dfs.create_dir(parent, recursive=True)
    tmp = f"{dp}.tmp-{uuid.uuid4().hex[:8]}"
    md5, n = hashlib.md5(), 0
    with sfs.open_input_stream(sp, compression=None) as fin, dfs.open_output_stream(tmp, compression=None) as fout:
        while True:
            chunk = fin.read(CHUNK)
            if not chunk:
                break
            md5.update(chunk)
            fout.write(chunk)
            n += len(chunk)
    dfs.move(tmp, dp)
    return n, md5.hexdigest()


def file_md5(path: str) -> str:
    fs, p = _fs_path(path)
    md5 = hashlib.md5()
    with fs.open_input_stream(p, compression=None) as fin:
        while True:
            chunk = fin.read(CHUNK)
            if not chunk:
                break
            md5.update(chunk)
    return md5.hexdigest()


def copy_range(src: str, temp: str, start: int, stop: int, size: int) -> str:
    """Copy bytes [start, stop) of *src*, a file of *size* bytes, to their place in the local file *temp*; their MD5."""
    fs, p = _fs_path(src)
    md5, at = hashlib.md5(), start
    os.makedirs(os.path.dirname(temp), exist_ok=True)
    out = os.open(temp, os.O_WRONLY | os.O_CREAT, 0o666)
    try:
        with fs.open_input_file(p) as fin:
            if fin.size() != size:
                raise OSError(f"{src} has {fin.size()} bytes, listed with {size}")
            fin.seek(start)
            while at < stop:
                chunk = fin.read(min(CHUNK, stop - at))
                if not chunk:
                    raise EOFError(f"{src} ends at byte {at}")
                md5.update(chunk)
                rest = memoryview(chunk)
                while rest:
                    n = os.pwrite(out, rest, at)
                    at, rest = at + n, rest[n:]
    finally:
        os.close(out)
    return md5.hexdigest()


def commit_ranges(temp: str, dest: str, size: int, digests: list[str]) -> str:
    """Rename *temp*, whole now, to *dest*; again without harm when the task is retried.  Returns the digest of the digests."""
    if os.path.exists(temp):
        if os.path.getsize(temp) != size:
            raise OSError(f"{temp} has {os.path.getsize(temp)} bytes, not {size}")
        os.replace(temp, dest)
    elif not (os.path.exists(dest) and os.path.getsize(dest) == size):
        raise FileNotFoundError(temp)
    return hashlib.md5("".join(digests).encode()).hexdigest() + f"-{len(digests)}"


def _copy_large(jobs: DataFrame, n_ranges: int, part_bytes: int) -> DataFrame:
    """Copy ``jobs(key, path, dest, size)`` by ranges; one row per file.

    The ranges' outcomes are written to a table first: a commit that is retried
    finds them there and copies nothing again.
    """
    spark = jobs.sparkSession
    run = uuid.uuid4().hex[:8]
    starts = F.explode(F.expr(f"sequence(0L, size - 1, {int(part_bytes)}L)"))
    ranges = jobs.select("key", "path", "dest", "size", starts.alias("start")).repartition(n_ranges)
    temp_of = lambda dest: f"{_fs_path(dest)[1]}.tmp-{run}"

    def copy(batches):
        for pdf in batches:
            out = []
            for key, src, dest, size, start in zip(pdf["key"], pdf["path"], pdf["dest"], pdf["size"], pdf["start"]):
                try:
                    out.append((key, dest, size, start, copy_range(src, temp_of(dest), start, min(size, start + part_bytes), size), None))
                except Exception as exc:  # noqa: BLE001 - reported per file
                    out.append((key, dest, size, start, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=["key", "dest", "size", "start", "md5", "error"])

    def commit(batches):
        for pdf in batches:
            out = []
            for key, dest, size, parts, error in zip(pdf["key"], pdf["dest"], pdf["size"], pdf["parts"], pdf["error"]):
                md5 = None
                try:
                    if error is None:
                        md5 = commit_ranges(temp_of(dest), _fs_path(dest)[1], size, [p["md5"] for p in parts])
                    elif os.path.exists(temp_of(dest)):
                        os.remove(temp_of(dest))
                except Exception as exc:  # noqa: BLE001 - reported per file
                    error = f"{type(exc).__name__}: {exc}"
                out.append((key, dest, None if error else size, md5, error))
            yield pd.DataFrame(out, columns=["key", "dest", "bytes", "md5", "error"]).astype({"bytes": "Int64"})

    table = scratch_path(spark, "copied-ranges")
    ranges.mapInPandas(copy, "key string, dest string, size bigint, start bigint, md5 string, error string").write.parquet(table)
    try:
        files = spark.read.parquet(table).groupBy("key", "dest", "size").agg(
            F.sort_array(F.collect_list(F.struct("start", "md5"))).alias("parts"), F.max("error").alias("error"))
        rows = files.mapInPandas(commit, RESULT_SCHEMA).collect()  # one row per large file
    finally:
        delete_path(spark, table)
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def copy_files(jobs: DataFrame, partitions: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Copy ``jobs(key, path, dest)``; spread over *partitions* tasks.

    With a ``size`` column, files of more than *part_bytes* with a destination
    on a mounted file system are copied at once, by ranges.
    """
    large = None
    if "size" in jobs.columns:
        splits = F.coalesce((F.col("size") > part_bytes) & F.col("dest").rlike("^(file:|/)"), F.lit(False))
        many = jobs.filter(splits)
        n_ranges = many.agg(F.sum(F.ceil(F.col("size") / part_bytes))).first()[0]
        if n_ranges:
            large = _copy_large(many, int(n_ranges), part_bytes)
        jobs = jobs.filter(~splits)
    if partitions:
        jobs = jobs.repartition(partitions)

    def run(batches):
        for pdf in batches:
            out = []
            for key, src, dest in zip(pdf["key"], pdf["path"], pdf["dest"]):
                try:
                    n, digest = copy_file(src, dest)
                    out.append((key, dest, n, digest, None))
                except Exception as exc:  # noqa: BLE001 - reported per file
                    out.append((key, dest, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=["key", "dest", "bytes", "md5", "error"])

    whole = jobs.select("key", "path", "dest").mapInPandas(run, RESULT_SCHEMA)
    return whole if large is None else whole.unionByName(large)


def md5_files(files: DataFrame) -> DataFrame:
    """``(key, md5)`` of ``files(key, path)``, streamed in chunks per task."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "md5": [file_md5(p) for p in pdf["path"]]})

    return files.select("key", "path").mapInPandas(run, "key string, md5 string")
