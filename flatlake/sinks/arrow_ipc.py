"""Arrow IPC (Feather v2) files as a Spark Python data source.

Write: each task streams its Arrow batches into one IPC file per partition
value under a staging folder and reports the files; the driver commit moves
them into ``col=value/`` folders and then removes the files they replace (only
in partitions written by this job: dynamic overwrite); the abort path removes
the staged files.  Read: one input partition per file; partition columns come
from the path, types from all files together.  All file access goes through
``pyarrow.fs``, so the table may lie on any store that it reaches.

Register once per session: ``spark.dataSource.register(ArrowIpcDataSource)``,
then ``df.write.format("arrow_ipc")`` / ``spark.read.format("arrow_ipc")``.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

CODECS = {"zstd": "zstd", "lz4": "lz4", None: None, "none": None, "": None, "uncompressed": None}
_SAFE = "-_.+ "


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def filesystem(path: str):
    """``(pyarrow file system, path inside it)`` of a local path or a URI."""
    import pyarrow.fs as pafs

    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].strip("/")
    fs, inner = pafs.FileSystem.from_uri("s3://" + path[len("s3a://"):] if path.startswith("s3a://") else path)
    return fs, inner.rstrip("/")


def _escape(value) -> str:
    if value is None:
        return NULL_PARTITION
    return quote(str(value), safe=_SAFE)


@dataclass
class _Staged(WriterCommitMessage):
    files: list = field(default_factory=list)  # (staged path, final dir)


class ArrowIpcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.uri = options["path"]
        self.path = filesystem(self.uri)[1]
        self.partition_by = [c for c in options.get("partition_by", "").split(",") if c]
        codec = options.get("compression", "zstd")
        if codec not in CODECS:
            raise ValueError(f"feather supports zstd, lz4 or no compression, not {codec!r}")
        self.codec = CODECS[codec]
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        fs, _ = filesystem(self.uri)
        tag = f"{ctx.partitionId() if ctx else 0}-{ctx.attemptNumber() if ctx else 0}"
        stage = f"{self.path}/_staging-{self.job}"
        writers: dict = {}
        files = []
        opts = pa.ipc.IpcWriteOptions(compression=self.codec)
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if not self.partition_by:
                    groups = [((), batch)]
                else:
                    keys = pa.Table.from_batches([batch]).select(self.partition_by)
                    tbl = pa.Table.from_batches([batch])
                    combos = keys.group_by(self.partition_by).aggregate([]).to_pylist()
                    groups = []
                    for combo in combos:
                        mask = None
                        for c in self.partition_by:
                            col = tbl.column(c)
                            m = pa.compute.is_null(col) if combo[c] is None else pa.compute.equal(col, pa.scalar(combo[c], col.type))
                            mask = m if mask is None else pa.compute.and_(mask, m)
                        groups.append((tuple(combo[c] for c in self.partition_by), tbl.filter(mask)))
                for values, part in groups:
                    data = part.drop_columns(self.partition_by) if self.partition_by else part
                    if values not in writers:
                        sub = "/".join(f"{c}={_escape(v)}" for c, v in zip(self.partition_by, values))
                        final_dir = f"{self.path}/{sub}" if sub else self.path
                        staged = f"{stage}/{sub}/part-{tag}-{uuid.uuid4().hex[:8]}.feather"
                        fs.create_dir(posixpath.dirname(staged), recursive=True)
                        sink = fs.open_output_stream(staged, compression=None)
                        writers[values] = (sink, pa.ipc.new_file(sink, data.schema, options=opts))
                        files.append((staged, final_dir))
                    table = data if isinstance(data, pa.Table) else pa.Table.from_batches([data])
                    writers[values][1].write_table(table)
        finally:
            for sink, w in writers.values():
                w.close()
                sink.close()
        return _Staged(files=files)

    def commit(self, messages):
        import pyarrow.fs as pafs

        fs, _ = filesystem(self.uri)
        staged = [f for m in messages if m is not None for f in m.files]
        old = []
        for folder in sorted({d for _, d in staged}) if self.overwrite else []:
            found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
            old += [x.path for x in found if x.type == pafs.FileType.File and not x.base_name.startswith(("_", "."))]
        for src, folder in staged:
            fs.create_dir(folder, recursive=True)
            fs.move(src, f"{folder}/{posixpath.basename(src)}")
        for path in old:  # only now: a crash before leaves both generations, none lost
            fs.delete_file(path)
        self._drop_stage()

    def abort(self, messages):
        self._drop_stage()

    def _drop_stage(self):
        # The job's own staging folder (also holds files of failed attempts).
        import pyarrow.fs as pafs

        fs, _ = filesystem(self.uri)
        stage = f"{self.path}/_staging-{self.job}"
        if fs.get_file_info(stage).type == pafs.FileType.Directory:
            fs.delete_dir(stage)


class _FilePartition(InputPartition):
    def __init__(self, path: str, values: dict):
        super().__init__(path)
        self.path = path
        self.values = values


_PART_RE = re.compile(r"^([^=/]+)=([^/]*)$")


def _list_files(uri: str) -> list[tuple[str, dict]]:
    """``(path, partition values)`` of every data file, in order of path."""
    import pyarrow.fs as pafs

    fs, root = filesystem(uri)
    out = []
    for info in sorted(fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)), key=lambda x: x.path):
        segments = info.path[len(root) :].strip("/").split("/")
        if not info.path.endswith(".feather") or any(x.startswith(("_", ".")) for x in segments):
            continue
        pairs = [m.groups() for m in map(_PART_RE.match, segments[:-1]) if m]
        out.append((info.path, {k: None if v == NULL_PARTITION else unquote(v) for k, v in pairs}))
    return out


class ArrowIpcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.uri = options["path"]
        self.schema_ = schema

    def partitions(self):
        return [_FilePartition(p, v) for p, v in _list_files(self.uri)]

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, _ = filesystem(self.uri)
        wanted = to_arrow_schema(self.schema_)
        with fs.open_input_file(partition.path) as src:
            reader = pa.ipc.open_file(src)
            for i in range(reader.num_record_batches):
                batch = reader.get_batch(i)
                cols = []
                for f in wanted:
                    if f.name in batch.schema.names:
                        col = batch.column(f.name)
                        cols.append(col if pa.types.is_timestamp(f.type) or col.type == f.type else col.cast(f.type))
                    else:
                        value = partition.values.get(f.name)
                        cols.append(pa.array([value] * batch.num_rows, pa.string()) if f.name in partition.values else pa.nulls(batch.num_rows, f.type))
                yield pa.RecordBatch.from_arrays(cols, names=wanted.names)


class ArrowIpcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "arrow_ipc"

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        uri = self.options["path"]
        fs, _ = filesystem(uri)
        files = _list_files(uri)
        if not files:
            raise FileNotFoundError(f"no .feather files under {uri}")
        schemas = []
        for path, _ in files:
            with fs.open_input_file(path) as src:
                schemas.append(pa.ipc.open_file(src).schema.remove_metadata())
        arrow_schema = pa.unify_schemas(list(dict.fromkeys(schemas)), promote_options="permissive")
        for k in files[0][1]:
            arrow_schema = arrow_schema.append(pa.field(k, pa.string()))
        return from_arrow_schema(arrow_schema)

    def writer(self, schema, overwrite):
        return ArrowIpcWriter(self.options, schema, overwrite)

    def reader(self, schema):
        return ArrowIpcReader(self.options, schema)


def register(spark) -> None:
    spark.dataSource.register(ArrowIpcDataSource)
