from datetime import date

import pytest

from pyspark.sql import functions as F

from flat_files import CONTRACTS, OPENED, TODAY, packed, put_all, quote_day
from flatlake import ingest


def _read(spark, out, dataset="asset_class=us_options_opra/data_type=quotes_v1"):
    return spark.read.option("basePath", out).parquet(f"{out}/{dataset}")


def test_minimum_slice_prefix_filter(spark, bucket, tmp_path):
    out = str(tmp_path / "out")
    run = ingest(
        spark, bucket, out, ["options/quotes"],
        start_date=date(2024, 11, 5), end_date=date(2024, 11, 5),
        ticker_prefixes=["O:ZED"], columns=["ticker", "ask_price", "sip_timestamp"],
    )
    res = {r.status: r for r in run.result.collect()}
    assert set(res) == {"written"}
    df = _read(spark, out)
    assert df.count() == 5
    assert df.columns[:4] == ["ticker", "ask_price", "sip_timestamp", "sip_timestamp_ns"]
    assert dict(df.dtypes)["sip_timestamp"] == "timestamp"
    assert df.agg(F.min("sip_timestamp_ns")).first()[0] == OPENED


def test_rerun_skips_and_republish_replaces(spark, bucket, tmp_path):
    out = str(tmp_path / "out")
    kw = dict(start_date=date(2024, 11, 5), end_date=date(2024, 12, 31))
    r1 = ingest(spark, bucket, out, ["options/quotes"], **kw)
    assert sorted(r.status for r in r1.result.collect()) == ["written"] * 3
    assert _read(spark, out).count() == 21
    r2 = ingest(spark, bucket, out, ["options/quotes"], **kw)
    assert sorted(r.status for r in r2.result.collect()) == ["skipped"] * 3
    put_all(bucket, {"us_options_opra/quotes_v1/2024/11/2024-11-29.csv.gz": packed(quote_day({c: 5 for c in CONTRACTS}))})
    r3 = ingest(spark, bucket, out, ["options/quotes"], **kw)
    st = {r.key.rsplit("/", 1)[-1]: r.status for r in r3.result.collect()}
    assert st["2024-11-29.csv.gz"] == "written"
    assert _read(spark, out).filter(F.col("file_date") == "2024-11-29").count() == 15
    assert _read(spark, out).count() == 29


def test_empty_match_recorded_and_skipped(spark, bucket, tmp_path):
    out = str(tmp_path / "out")
    kw = dict(start_date=date(2024, 11, 5), end_date=date(2024, 11, 5), ticker_prefixes=["O:TSLA"])
    r1 = ingest(spark, bucket, out, ["options/quotes"], **kw)
    assert [r.status for r in r1.result.collect()] == ["empty"]
    import os

    assert not os.path.exists(f"{out}/asset_class=us_options_opra")  # no output for no rows
    r2 = ingest(spark, bucket, out, ["options/quotes"], **kw)
    assert [r.status for r in r2.result.collect()] == ["skipped"]


def test_latest_and_types(spark, bucket, tmp_path):
    out = str(tmp_path / "out")
    run = ingest(spark, bucket, out, ["stocks/day_aggs"], latest=3, today=TODAY,
                 tickers=["KIT", "ZED"], columns=["ticker", "close"])
    assert sorted(r.status for r in run.result.collect()) == ["written"] * 3
    df = spark.read.parquet(out + "/asset_class=us_stocks_sip")
    assert sorted({r.ticker for r in df.collect()}) == ["KIT", "ZED"]
    assert df.columns[:2] == ["ticker", "close"]


def test_failed_file_isolated(spark, bucket, tmp_path):
    put_all(bucket, {"us_options_opra/quotes_v1/2024/11/2024-11-30.csv.gz": b"definitely not gzip"})
    out = str(tmp_path / "out")
    run = ingest(spark, bucket, out, ["options/quotes"], start_date=date(2024, 11, 5), end_date=date(2024, 11, 30))
    st = {r.key.rsplit("/", 1)[-1]: r.status for r in run.result.collect()}
    assert st["2024-11-30.csv.gz"] == "failed"
    assert st["2024-11-05.csv.gz"] == "written"
    assert not run.ok


def test_dry_run_and_force(spark, bucket, tmp_path):
    out = str(tmp_path / "out")
    kw = dict(start_date=date(2024, 11, 5), end_date=date(2024, 11, 29))
    dry = ingest(spark, bucket, out, ["options/quotes"], dry_run=True, **kw)
    assert sorted(r.status for r in dry.result.collect()) == ["planned", "planned"]
    ingest(spark, bucket, out, ["options/quotes"], **kw)
    forced = ingest(spark, bucket, out, ["options/quotes"], force=True, **kw)
    assert sorted(r.status for r in forced.result.collect()) == ["written", "written"]
    assert _read(spark, out).count() == 14


def test_changed_settings_and_deleted_output_repull(spark, bucket, tmp_path):
    import shutil

    out = str(tmp_path / "out")
    kw = dict(start_date=date(2024, 11, 5), end_date=date(2024, 11, 29))
    ingest(spark, bucket, out, ["options/quotes"], **kw)
    changed = ingest(spark, bucket, out, ["options/quotes"], ticker_prefixes=["O:ZED"], **kw)
    assert {r.reason for r in changed.result.collect()} == {"changed"}
    assert _read(spark, out).count() == 10
    shutil.rmtree(f"{out}/asset_class=us_options_opra/data_type=quotes_v1/file_date=2024-11-05")
    again = ingest(spark, bucket, out, ["options/quotes"], ticker_prefixes=["O:ZED"], **kw)
    st = {r.key.rsplit("/", 1)[-1]: (r.status, r.reason) for r in again.result.collect()}
    assert st["2024-11-05.csv.gz"] == ("written", "output missing")
    assert st["2024-11-29.csv.gz"][0] == "skipped"


def test_other_formats_and_row_filter(spark, bucket, tmp_path):
    from flatlake.sinks.formats import read_output

    out = str(tmp_path / "out")
    run = ingest(spark, bucket, out, ["stocks/day_aggs"], start_date=date(2024, 11, 5), end_date=date(2024, 12, 31),
                 output_format="csv.gz", row_filter=F.col("volume") > 1000, row_filter_id="volume over 1000")
    assert sorted(r.rows for r in run.result.collect()) == [2, 2]
    back = read_output(spark, "csv.gz", out)
    assert back.count() == 4
    assert back.first().window_start.endswith("Z")
    with pytest.raises(ValueError):
        ingest(spark, bucket, out, ["stocks/day_aggs"], latest=1, row_filter=F.col("volume") > 1)


def test_raw_mirror(spark, bucket, tmp_path):
    import os

    out = str(tmp_path / "raw")
    run = ingest(spark, bucket, out, ["options/quotes"], start_date=date(2024, 11, 5), end_date=date(2024, 12, 31), output_format="raw")
    assert sorted(r.status for r in run.result.collect()) == ["written"] * 3
    rel = "us_options_opra/quotes_v1/2024/11/2024-11-05.csv.gz"
    assert open(os.path.join(out, rel), "rb").read() == open(os.path.join(bucket, rel), "rb").read()
    again = ingest(spark, bucket, out, ["options/quotes"], start_date=date(2024, 11, 5), end_date=date(2024, 12, 31), output_format="raw")
    assert sorted(r.status for r in again.result.collect()) == ["skipped"] * 3
    with pytest.raises(ValueError, match="raw"):
        ingest(spark, bucket, out, ["options/quotes"], latest=1, output_format="raw", tickers=["A"])


def test_duplicate_output_paths_rejected(spark, bucket, tmp_path):
    with pytest.raises(ValueError, match="same output"):
        ingest(spark, bucket, str(tmp_path / "o"), ["options/quotes"], start_date=date(2024, 11, 5),
               end_date=date(2024, 12, 31), path_template="{name}.{ext}")


def test_underlying_preset(spark, bucket, tmp_path):
    from flatlake import ingest_underlying

    out = str(tmp_path / "out")
    run = ingest_underlying(spark, bucket, out, "ZED", start_date=date(2024, 11, 5), end_date=date(2024, 11, 5))
    assert [r.status for r in run.result.collect()] == ["written"]
    assert _read(spark, out).count() == 5
    with pytest.raises(ValueError):
        ingest_underlying(spark, bucket, out, "ZED", data_type="bars", latest=1)


def test_truncated_gzip_isolated_by_bisection(spark, bucket, tmp_path):
    import gzip as gz

    from flatlake.ingest import _bisect_stage

    good = packed(quote_day({c: 2000 for c in CONTRACTS}))
    # valid head (so sampling succeeds) but cut off mid-stream
    put_all(bucket, {"us_options_opra/quotes_v1/2024/11/2024-11-30.csv.gz": good[: len(good) // 2]})
    out = str(tmp_path / "out")
    run = ingest(spark, bucket, out, ["options/quotes"], start_date=date(2024, 11, 5), end_date=date(2024, 11, 30))
    st = {r.key.rsplit("/", 1)[-1]: r.status for r in run.result.collect()}
    assert st == {"2024-11-05.csv.gz": "written", "2024-11-29.csv.gz": "written", "2024-11-30.csv.gz": "failed"}
    calls = []

    def stage(ps):
        calls.append(list(ps))
        if "bad" in ps:
            raise IOError("broken")
        return ps

    frames, broken = _bisect_stage(stage, [f"f{i}" for i in range(15)] + ["bad"])
    assert list(broken) == ["bad"] and sum(len(f) for f in frames) == 15
    assert len(calls) <= 2 * 5


def test_manifest_auto_compaction(spark, bucket, tmp_path):
    from flatlake.plans import manifest as M

    out = str(tmp_path / "out")
    kw = dict(start_date=date(2024, 11, 5), end_date=date(2024, 11, 29), manifest_compact_after=2)
    ingest(spark, bucket, out, ["options/quotes"], **kw)
    ingest(spark, bucket, out, ["options/quotes"], ticker_prefixes=["O:KIT"], **kw)
    ingest(spark, bucket, out, ["options/quotes"], ticker_prefixes=["O:ZED"], **kw)
    assert M.read_log(spark, out).count() == 2
    assert {r.rows for r in M.read_current(spark, out).collect()} == {5}


def test_two_datasets_keep_their_own_columns(spark, bucket, tmp_path):
    out = str(tmp_path / "out")
    run = ingest(spark, bucket, out, ["options/quotes", "stocks/day_aggs"], start_date=date(2024, 11, 29), end_date=date(2024, 11, 29))
    assert sorted(r.status for r in run.result.collect()) == ["written", "written"]
    q = spark.read.parquet(out + "/asset_class=us_options_opra/data_type=quotes_v1")
    a = spark.read.parquet(out + "/asset_class=us_stocks_sip/data_type=day_aggs_v1")
    assert "volume" not in q.columns and "ask_price" in q.columns
    assert "ask_price" not in a.columns and dict(a.dtypes)["otc"] == "boolean"


def test_lz4_source_rejected_alone(spark, bucket, tmp_path):
    import pyarrow as pa

    raw = b"ticker,ask_price,bid_price,sip_timestamp\nO:ZED1,1.0,0.5,5\n"
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as out:
        out.write(raw)
    put_all(bucket, {"us_options_opra/quotes_v1/2024/11/2024-11-30.csv.lz4": sink.getvalue().to_pybytes()})
    run = ingest(spark, bucket, str(tmp_path / "out"), ["options/quotes"], start_date=date(2024, 11, 5),
                 end_date=date(2024, 11, 30), path_template="{dataset}/{filename}.{ext}")
    res = {r.key.rsplit("/", 1)[-1]: r for r in run.result.collect()}
    assert res["2024-11-30.csv.lz4"].status == "failed"
    assert "lz4" in res["2024-11-30.csv.lz4"].error
    assert res["2024-11-05.csv.gz"].status == "written"
