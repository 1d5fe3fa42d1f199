import gzip
import os

from pyspark.sql import types as T

from flat_files import packed, put_all, quote_day
from flatlake.streaming.available_now import stream_csv_available_now, stream_ingest


def _write(dirpath, name, rows):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as fh:
        fh.write("ticker,px\n" + "".join(f"{t},{p}\n" for t, p in rows))


def test_available_now_picks_up_new_files_only(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("px", T.StringType())])
    _write(os.path.join(src, "d1"), "a.csv", [("A", 1.0), ("B", 2.0)])
    stream_csv_available_now(spark, src, schema, out, {"px": T.DoubleType()}, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == 2
    _write(os.path.join(src, "d2"), "b.csv", [("C", 3.0)])
    stream_csv_available_now(spark, src, schema, out, {"px": T.DoubleType()}, checkpoint=ckpt)
    df = spark.read.parquet(out)
    assert df.count() == 3
    assert dict(df.dtypes)["px"] == "double"


def test_stream_ingest_catch_up(spark, tmp_path):
    from flatlake.sources.schema import parse_column_types

    src, out = str(tmp_path / "bucket"), str(tmp_path / "out")
    put_all(src, {"us_options_opra/quotes_v1/2025/03/2025-03-17.csv.gz": packed(quote_day())})
    schema = T.StructType([
        T.StructField("ticker", T.StringType()), T.StructField("ask_price", T.DoubleType()),
        T.StructField("bid_price", T.DoubleType()), T.StructField("sip_timestamp", T.LongType()),
    ])
    r1 = stream_ingest(spark, src, out, "options/quotes", schema, ticker_prefixes=["O:ZED"])
    assert [(r.status, r.rows) for r in r1.collect()] == [("written", 5)]
    put_all(src, {
        "us_options_opra/quotes_v1/2025/03/2025-03-18.csv.gz": packed(quote_day()),
        "us_options_opra/quotes_v1/2025/03/2025-03-19.csv.gz": gzip.compress(b"ticker,ask_price,bid_price,sip_timestamp\nO:ZEDX,x,1,2\n"),
    })
    r2 = {r.key.rsplit("/", 1)[-1]: r.status for r in stream_ingest(spark, src, out, "options/quotes", schema, ticker_prefixes=["O:ZED"]).collect()}
    assert r2 == {"2025-03-18.csv.gz": "written", "2025-03-19.csv.gz": "failed"}
    df = spark.read.parquet(out + "/asset_class=us_options_opra")
    assert df.count() == 10
    assert "sip_timestamp_ns" in df.columns
    assert stream_ingest(spark, src, out, "options/quotes", schema).count() == 0


def _day(day, rows, part=""):
    body = "ticker,px\n" + "".join(f"{t},{p}\n" for t, p in rows)
    return {f"us_options_opra/quotes_v1/2025/03/2025-03-{day:02d}{part}.csv.gz": gzip.compress(body.encode())}


def test_stream_batches_of_any_size_add_up(spark, tmp_path):

    src, out = str(tmp_path / "bucket"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("px", T.DoubleType())])
    put_all(src, {**_day(17, [("A", 1)]), **_day(17, [("B", 2)], ".p00001"), "us_options_opra/quotes_v1/2025/03/notes.txt": b"ticker,px\nZ,9\n"})
    first = stream_ingest(spark, src, out, "options/quotes", schema, max_files_per_trigger=1).collect()
    assert sorted(r.status for r in first) == ["written", "written"]
    put_all(src, {
        **_day(17, [("C", 3)], ".p00002"),
        "us_options_opra/quotes_v1/2025/03/2025-03-18.csv.gz": gzip.compress(b"px,ticker\n1,A\n"),
        "us_options_opra/quotes_v1/2025/03/2025-03-19.csv.gz": gzip.compress(b"ticker,px\nA,1,x,y\n"),
    })
    second = {r.key.rsplit("/", 1)[-1]: r.status for r in stream_ingest(spark, src, out, "options/quotes", schema, columns=["ticker"]).collect()}
    assert second == {"2025-03-17.p00002.csv.gz": "written", "2025-03-18.csv.gz": "failed", "2025-03-19.csv.gz": "failed"}
    assert sorted(r.ticker for r in spark.read.parquet(out + "/asset_class=us_options_opra").collect()) == ["A", "B", "C"]


def test_stream_sees_republished_files(spark, tmp_path):
    src, out = str(tmp_path / "bucket"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("px", T.DoubleType())])
    run = lambda: {r.key.rsplit("/", 1)[-1]: (r.status, r.rows, r.reason) for r in stream_ingest(spark, src, out, "options/quotes", schema).collect()}
    put_all(src, {**_day(17, [("A", 1)]), **_day(18, [("B", 2)])})
    assert run() == {"2025-03-17.csv.gz": ("written", 1, "new"), "2025-03-18.csv.gz": ("written", 1, "new")}
    put_all(src, _day(18, [("B", 3), ("C", 4)]))
    assert run() == {"2025-03-18.csv.gz": ("written", 2, "changed")}
    table = lambda: sorted((r.ticker, r.px) for r in spark.read.parquet(out + "/asset_class=us_options_opra").collect())
    assert table() == [("A", 1.0), ("B", 3.0), ("C", 4.0)]
    # back to what it was before: a change again
    put_all(src, _day(18, [("B", 2)]))
    assert run() == {"2025-03-18.csv.gz": ("written", 1, "changed")}
    assert table() == [("A", 1.0), ("B", 2.0)] and run() == {}


def test_unreadable_gzip_does_not_stop_the_stream(spark, tmp_path):
    src, out = str(tmp_path / "bucket"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("px", T.DoubleType())])
    whole = gzip.compress(b"ticker,px\n" + b"".join(b"T%d,%d\n" % (i, i) for i in range(40000)))
    put_all(src, {**_day(17, [("A", 1)]), "us_options_opra/quotes_v1/2025/03/2025-03-18.csv.gz": whole[: len(whole) // 2], "us_options_opra/quotes_v1/2025/03/2025-03-19.csv.gz": b"no gzip"})
    got = {r.key.rsplit("/", 1)[-1]: r.status for r in stream_ingest(spark, src, out, "options/quotes", schema).collect()}
    assert got == {"2025-03-17.csv.gz": "written", "2025-03-18.csv.gz": "failed", "2025-03-19.csv.gz": "failed"}


def test_batch_stream_and_templates_share_one_table(spark, tmp_path):
    from datetime import date

    from flatlake import ingest

    src, out = str(tmp_path / "bucket"), str(tmp_path / "out")
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("px", T.DoubleType())])
    kw = dict(start_date=date(2025, 3, 1), end_date=date(2025, 3, 31), column_types={"ticker": "string", "px": "float64"})
    table = lambda: sorted((r.ticker, r.px) for r in spark.read.parquet(out).collect())
    reasons = lambda run: {r.reason for r in run.result.collect()}
    put_all(src, {**_day(17, [("A", 1), ("B", 2)])})
    assert reasons(ingest(spark, src, out, "options/quotes", **kw)) == {"new"}
    # the stream has the same settings and types: the manifest knows the file
    assert [r.status for r in stream_ingest(spark, src, out, "options/quotes", schema).collect()] == ["skipped"]
    assert reasons(ingest(spark, src, out, "options/quotes", path_template="t/{date}.{ext}", **kw)) == {"changed"}
    assert reasons(ingest(spark, src, out, "options/quotes", path_template="t/{date}.{ext}", **kw)) == {"up to date"}
    moved = str(tmp_path / "moved")
    put_all(moved, {**_day(17, [("A", 1), ("B", 2)])})
    stream_ingest(spark, moved, out, "options/quotes", schema, checkpoint=str(tmp_path / "other"))
    assert table() == [("A", 1.0), ("B", 2.0)]
