"""Line ends inside quotes and row numbers over several splits of a file."""

import bz2
import csv
import io
import random

import pytest
from pyspark.sql import types as T

from flatlake import ingest
from flatlake.session import session_conf
from flatlake.sources.csv_scan import ROW_BAD, scan_csv
from flatlake.sources.records import csv_records, file_lines
from flat_files import QUOTES, key_of, packed, put, quote_day

from datetime import date

TINY = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
TEXT = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()), T.StructField("n", T.DoubleType())])


def notes(n, seed=1):
    rnd = random.Random(seed)
    words = ["a", 'say "hi"', "\n", "\n\n", ",", "é", '"', "word " * 9, " "]
    return [(i, "x" + "".join(rnd.choice(words) for _ in range(rnd.randint(0, 8))) + "x", i / 4) for i in range(n)]


def as_csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([("id", "note", "n"), *rows])
    return out.getvalue().encode()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_splits(spark, tmp_path, end):
    rows = {f"f{i}.csv": notes(120, i) for i in range(3)}
    rows["long.csv"] = [(0, "one\n" * 900, 0.0), (1, "plain", 0.25), (2, 'q"\n' * 500, 0.5)]
    rows["head.csv"] = []
    for name, own in rows.items():
        (tmp_path / name).write_bytes(as_csv(own, end))
    paths = [f"file:{tmp_path}/{name}" for name in rows]
    with session_conf(spark, TINY):
        assert file_lines(spark, paths).select("path", "split").distinct().count() > 3 * len(rows)
        got = scan_csv(spark, paths, TEXT, multi_line=True, number="row").collect()
    for name, own in rows.items():
        mine = sorted((r["row"], r["id"], r["note"], r["n"]) for r in got if r["_path"].endswith("/" + name))
        assert mine == [(k, *row) for k, row in enumerate(own)]
    assert not any(r[ROW_BAD] for r in got)


def test_bz2_and_gzip_files(spark, tmp_path):
    import gzip

    rows = notes(400, 9)
    (tmp_path / "a.csv.bz2").write_bytes(bz2.compress(as_csv(rows)))
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(as_csv(rows)))
    with session_conf(spark, TINY):
        got = scan_csv(spark, [f"file:{tmp_path}/{n}" for n in ("a.csv.bz2", "b.csv.gz")], TEXT, multi_line=True, number="row").collect()
    for name in ("a.csv.bz2", "b.csv.gz"):
        assert sorted((r["row"], r["id"], r["note"]) for r in got if r["_path"].endswith(name)) == [(k, i, t) for k, (i, t, _) in enumerate(rows)]


def test_a_quote_that_never_closes_makes_a_bad_row(spark, tmp_path):
    (tmp_path / "open.csv").write_bytes(b'id,note,n\n1,fine,1\n2,"open\n' + b"3,lost,1\n" * 300)
    (tmp_path / "short.csv").write_bytes(b"id,note,n\n1,fine,1\n2,x\n\n   \n3,y,2,z\n")
    with session_conf(spark, TINY):
        got = scan_csv(spark, [f"file:{tmp_path}/{n}" for n in ("open.csv", "short.csv")], TEXT, multi_line=True, number="row").collect()
    bad = sorted((r["_path"].rsplit("/", 1)[-1], r["row"], r[ROW_BAD]) for r in got)
    assert bad == [("open.csv", 0, False), ("open.csv", 1, True), ("short.csv", 0, False), ("short.csv", 1, True), ("short.csv", 2, True)]


def test_blank_lines_are_no_records(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'\nid\n1\n\n"2"\n \n"a\n\nb"\n')
    got = csv_records(spark, [f"file:{tmp_path}/f.csv"]).orderBy("number").collect()
    assert [(r["number"], r["record"], r["whole"]) for r in got] == [(0, "id", True), (1, "1", True), (2, '"2"', True), (3, '"a\n\nb"', True)]


def test_a_column_named_like_the_row_number_is_refused(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"id,note,n\n1,a,1\n")
    with pytest.raises(ValueError, match="row numbers"):
        scan_csv(spark, [f"file:{tmp_path}/f.csv"], TEXT, number="n")


def test_ingest_keeps_row_numbers_and_order(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    days = quote_day({"O:ZED1": 40, "O:KIT1": 25, "O:ZED2": 30})
    for day in (date(2024, 11, 5), date(2024, 11, 6)):
        put(src, key_of(QUOTES, day, suffix=".csv"), packed(days, zipped=False))
    kw = dict(start_date=date(2024, 11, 1), end_date=date(2024, 11, 30), ticker_prefixes=["O:ZED"], columns=["ticker", "bid_price"], row_number="place")
    with session_conf(spark, TINY):
        run = ingest(spark, src, out, QUOTES, **kw)
    assert [r.rows for r in run.result.collect()] == [70, 70]
    want = [(i, t) for i, t in enumerate(days["ticker"]) if t.startswith("O:ZED")]
    for day in ("2024-11-05", "2024-11-06"):
        got = spark.read.parquet(out).filter(f"file_date = '{day}'")
        assert sorted((r["place"], r["ticker"]) for r in got.collect()) == want
        files = got.selectExpr("_metadata.file_name as f", "_metadata.row_index as i", "place").orderBy("f", "i").collect()
        assert [r["place"] for r in files] == [i for i, _ in want]
    again = ingest(spark, src, out, QUOTES, **{**kw, "row_number": "line"})
    assert {r.reason for r in again.result.collect()} == {"changed"}
