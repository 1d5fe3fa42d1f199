import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from flatlake.functions.epoch import convert_epochs
from flatlake.sinks.formats import format_names, get_format, list_formats, normalize_compression, read_output
from flatlake.sinks.raw import copy_files, md5_files

NS = 1_700_000_000_000_000_000


def _batch(spark, n, offset=0):
    rows = [(f"T{i}", float(i), NS + i, "a" if i % 2 else "b") for i in range(offset, offset + n)]
    df = spark.createDataFrame(rows, "ticker string, px double, ts long, part string")
    return convert_epochs(df, ["ts"], "ns")


@pytest.mark.parametrize("name", [n for n in format_names() if n != "raw"])
def test_write_two_batches_and_read_back(spark, tmp_path, name):
    out = str(tmp_path / "out")
    fmt = get_format(name)
    fmt.write(_batch(spark, 3), out, "default", ["part"])
    fmt.write(_batch(spark, 4, 3), out, "default", ["part"], mode="append")
    back = read_output(spark, name, out)
    assert back.count() == 7
    if name in ("jsonl", "jsonl.gz", "csv", "csv.gz"):
        ts = {r.ticker: r.ts for r in back.collect()}
        assert ts["T1"] == "2023-11-14T22:13:20.000000001Z"
    else:
        r = back.filter(F.col("ticker") == "T1").first()
        assert r.ts_ns == NS + 1


def test_jsonl_keeps_nulls(spark, tmp_path):
    out = str(tmp_path / "j")
    df = spark.createDataFrame([("A", None)], "ticker string, px double")
    get_format("jsonl").write(df, out)
    lines = []
    for f in sorted(p for p in os.listdir(out) if p.endswith(".json")):
        lines += [ln for ln in open(os.path.join(out, f)).read().splitlines() if ln]
    assert [json.loads(ln) for ln in lines] == [{"ticker": "A", "px": None}]


def test_codecs_and_registry(spark):
    assert normalize_compression("NONE") is None
    assert get_format("parquet").resolve_compression("default") == "zstd"
    assert get_format("parquet").codecs[get_format("parquet").resolve_compression("lz4")] == "lz4_raw"
    with pytest.raises(ValueError):
        get_format("parquet").resolve_compression("brotli")
    with pytest.raises(ValueError):
        get_format("jsonl").resolve_compression("zstd")
    with pytest.raises(ValueError, match="Available"):
        get_format("xml")
    names = [r.name for r in list_formats(spark).collect()]
    assert names == sorted(names) and "feather" in names and "raw" in names


def test_csv_quoting(spark, tmp_path):
    out = str(tmp_path / "c")
    df = spark.createDataFrame([('a,b', 'say "hi"', "")], "x string, y string, z string")
    get_format("csv").write(df, out)
    lines = []
    for f in sorted(p for p in os.listdir(out) if p.endswith(".csv")):
        lines += open(os.path.join(out, f)).read().splitlines()
    assert "x,y,z" in lines
    assert '"a,b","say ""hi""",""' in lines


def test_raw_copy(spark, tmp_path):
    src = tmp_path / "src.csv.gz"
    src.write_bytes(gzip.compress(b"a,b\n1,2\n"))
    jobs = spark.createDataFrame([("k", "file:" + str(src), str(tmp_path / "o" / "k.csv.gz"))], "key string, path string, dest string")
    r = copy_files(jobs).first()
    assert r.error is None and r.bytes == src.stat().st_size
    assert (tmp_path / "o" / "k.csv.gz").read_bytes() == src.read_bytes()
    m = md5_files(spark.createDataFrame([("k", "file:" + str(src))], "key string, path string")).first()
    assert m.md5 == r.md5


def test_raw_copy_by_ranges(spark, tmp_path):
    """Files above a range go in several tasks and arrive whole; a wrong size or a missing source fails that file alone."""
    contents = {"a": os.urandom(100_003), "b": os.urandom(30_000), "c": os.urandom(9_999), "d": b"", "e": os.urandom(50_000)}
    for k, v in contents.items():
        (tmp_path / k).write_bytes(v)
    out = tmp_path / "deep" / "o"
    sizes = {**{k: len(v) for k, v in contents.items()}, "c": None, "e": 50_001, "gone": 20_000}
    jobs = spark.createDataFrame([(k, str(tmp_path / k), f"file:{out}/{k}", n) for k, n in sizes.items()], "key string, path string, dest string, size bigint")
    got = {r.key: r for r in copy_files(jobs, part_bytes=10_000).collect()}
    assert set(got) == set(sizes)
    assert {k for k, r in got.items() if r.error} == {"e", "gone"}
    for k in "abcd":
        assert (out / k).read_bytes() == contents[k] and got[k].bytes == len(contents[k])
    assert got["a"].md5.endswith("-11") and got["b"].md5.endswith("-3")
    parts = [hashlib.md5(contents["b"][i : i + 10_000]).hexdigest() for i in range(0, 30_000, 10_000)]
    assert got["b"].md5 == hashlib.md5("".join(parts).encode()).hexdigest() + "-3"
    assert sorted(os.listdir(out)) == ["a", "b", "c", "d"]  # no temp file stays


def test_range_commit_twice(tmp_path):
    """A retried commit finds its work done; a temp file that is not whole is no copy."""
    from flatlake.sinks.raw import commit_ranges

    temp, dest = str(tmp_path / "t"), str(tmp_path / "d")
    open(temp, "wb").write(b"123")
    with pytest.raises(OSError):
        commit_ranges(temp, dest, 4, ["x"])
    assert commit_ranges(temp, dest, 3, ["x"]) == commit_ranges(temp, dest, 3, ["x"])
    assert open(dest, "rb").read() == b"123"


def test_register_custom_spark_format(spark, tmp_path):
    from flatlake.sinks.formats import FORMATS, register_spark_format

    fmt = register_spark_format("orc", "orc", "orc", default_compression="zstd", codecs={"zstd": "zstd", None: "none"})
    try:
        out = str(tmp_path / "orc")
        fmt.write(_batch(spark, 5), out, "default", ["part"])
        assert spark.read.orc(out).count() == 5
        assert "orc" in format_names()
    finally:
        FORMATS.pop("orc", None)


def test_feather_null_partition_overwrite_and_new_column(spark, tmp_path):
    out = str(tmp_path / "f")
    fmt = get_format("feather")
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a b/c")], "x bigint, p string")
    fmt.write(df, out, "default", ["p"])
    assert sorted((r.x, r.p) for r in read_output(spark, "feather", out).collect()) == [(1, "a"), (2, None), (3, "a b/c")]
    again = spark.createDataFrame([(20, None, "n")], "x bigint, p string, y string")
    fmt.write(again, out, "default", ["p"])
    assert sorted((r.x, r.p, r.y) for r in read_output(spark, "feather", out).collect()) == [(1, "a", None), (3, "a b/c", None), (20, None, "n")]


def test_json_of_binary_and_infinities(spark, tmp_path):
    out = str(tmp_path / "j")
    df = spark.createDataFrame([(1, bytearray(b"ok"), 1.5), (2, bytearray(b"a\xff"), float("inf")), (3, None, float("nan"))], "x bigint, b binary, v double")
    get_format("jsonl").write(df, out)
    rows = {r.x: (r.b, r.v) for r in spark.read.schema("x bigint, b string, v double").json(out).collect()}
    assert rows == {1: ("ok", 1.5), 2: ("a\ufffd", None), 3: (None, None)}
    import pytest

    with pytest.raises(ValueError):
        get_format("csv").write(df, out, "zstd")
