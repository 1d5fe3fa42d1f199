"""Each source file owns its output: siblings, datasets, failures, types and paths."""

import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F

from flat_files import put_all
from flatlake import ingest
from flatlake.plans import manifest as M

PREFIX = "us_options_opra/quotes_v1"
SPAN = dict(start_date=date(2025, 3, 1), end_date=date(2025, 3, 31), path_template="{dataset}/{date}/{filename}.{ext}")


def obj(day, text, part="", prefix=PREFIX):
    return {f"{prefix}/2025/03/2025-03-{day:02d}{part}.csv.gz": gzip.compress(text.encode())}


def statuses(run):
    return {r.key.rsplit("/", 1)[-1]: r.status for r in run.result.collect() if r.key}


def rows(spark, out):
    return sorted(spark.read.parquet(out).select("ticker", F.col("px").cast("double")).collect())


@pytest.mark.parametrize("partition_by", [("asset_class", "data_type", "file_date"), ("asset_class", "data_type", "year", "month"), ("file_date",)])
def test_late_sibling_and_next_day(spark, tmp_path, partition_by):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, obj(17, "ticker,px\nA,1\n"))
    ingest(spark, src, out, PREFIX, partition_by=partition_by, **SPAN)
    put_all(src, {**obj(17, "ticker,px\nB,2\n", ".p00001"), **obj(18, "ticker,px\nC,3\n")})
    run = ingest(spark, src, out, PREFIX, partition_by=partition_by, **SPAN)
    assert statuses(run) == {"2025-03-17.csv.gz": "skipped", "2025-03-17.p00001.csv.gz": "written", "2025-03-18.csv.gz": "written"}
    assert [tuple(r) for r in rows(spark, out)] == [("A", 1.0), ("B", 2.0), ("C", 3.0)]
    ingest(spark, src, out, PREFIX, partition_by=partition_by, force=True, **SPAN)
    assert len(rows(spark, out)) == 3


def test_datasets_and_templates_do_not_erase_each_other(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    other = "us_options_opra/trades_v1"
    put_all(src, {**obj(17, "ticker,px\nA,1\n"), **obj(17, "ticker,px,size\nB,2,5\n", prefix=other)})
    run = ingest(spark, src, out, [PREFIX, other], partition_by=("file_date",), **SPAN)
    assert set(r.status for r in run.result.collect()) == {"written"}
    assert len(rows(spark, out)) == 2
    out2 = str(tmp_path / "o2")
    days = {k: v for k, v in SPAN.items() if k != "path_template"}
    put_all(src, obj(18, "ticker,px\nA,1\nB,2\n"))
    ingest(spark, src, out2, PREFIX, tickers=["A"], path_template="a/{date}.{ext}", **days)
    run = ingest(spark, src, out2, PREFIX, tickers=["B"], path_template="b/{date}.{ext}", **days)
    assert statuses(run)["2025-03-18.csv.gz"] == "written"
    assert ("B", 2.0) in [tuple(r) for r in rows(spark, out2)]


def test_failed_file_leaves_its_old_rows(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, {**obj(17, "ticker,px\nA,1\n"), **obj(17, "ticker,px\nB,2\n", ".p00001")})
    ingest(spark, src, out, PREFIX, column_types={"px": "float64"}, **SPAN)
    put_all(src, obj(17, "ticker,px\nB,2\nB,oops\n", ".p00001"))
    run = ingest(spark, src, out, PREFIX, column_types={"px": "float64"}, **SPAN)
    assert statuses(run)["2025-03-17.p00001.csv.gz"] == "failed" and not run.ok
    assert [tuple(r) for r in rows(spark, out)] == [("A", 1.0), ("B", 2.0)]


def test_types_widen_across_runs(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, obj(17, "ticker,px\nA,1\n"))
    ingest(spark, src, out, PREFIX, **SPAN)
    put_all(src, obj(18, "ticker,px\nB,2.5\n"))
    ingest(spark, src, out, PREFIX, **SPAN)
    put_all(src, obj(19, "ticker,px,extra\nC,3,x\n"))
    ingest(spark, src, out, PREFIX, **SPAN)
    df = spark.read.parquet(out)
    assert dict(df.dtypes)["px"] == "double"
    assert [tuple(r) for r in rows(spark, out)] == [("A", 1.0), ("B", 2.5), ("C", 3.0)]


def test_paths_that_need_encoding(spark, tmp_path):
    src, out = str(tmp_path / "b with space + 100%"), str(tmp_path / "o ut")
    put_all(src, {**obj(17, "ticker,px\nA,1\n"), **obj(18, "ticker,px\nA,1\nB\n")})
    run = ingest(spark, src, out, PREFIX, **SPAN)
    got = {r.key.rsplit("/", 1)[-1]: (r.status, r.rows) for r in run.result.collect()}
    assert got == {"2025-03-17.csv.gz": ("written", 1), "2025-03-18.csv.gz": ("failed", None)}
    assert statuses(ingest(spark, src, out, PREFIX, **SPAN)) == {"2025-03-17.csv.gz": "skipped", "2025-03-18.csv.gz": "failed"}


def test_deep_prefix_and_dataset_without_files(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, obj(17, "ticker,px\nA,1\n", prefix="a/b/c"))
    run = ingest(spark, src, out, ["a/b/c", "a/b/d"], **SPAN)
    assert sorted(r.status for r in run.result.collect()) == ["no files", "written"]
    assert run.ok and len(rows(spark, out)) == 1


def test_census_reads_like_the_scan(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, {
        **obj(17, 'ticker,bid price,note,px\nA,1,"say ""hi"", you",7\n'),
        **obj(18, "ticker,px,PX\nA,1,2\n"),
        **obj(19, 'ticker,note,px\nA,"two\nlines",7\n'),
    })
    run = ingest(spark, src, out, PREFIX, multi_line=True, **SPAN)
    assert statuses(run) == {"2025-03-17.csv.gz": "written", "2025-03-18.csv.gz": "failed", "2025-03-19.csv.gz": "written"}
    kinds = dict(spark.read.parquet(out).dtypes)
    assert kinds["px"] == "bigint"


def test_one_dataset_does_not_retype_another(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    other = "us_options_opra/trades_v1"
    put_all(src, {**obj(17, "ticker,px\nA,1\n"), **obj(17, "ticker,px\nB,text\n", prefix=other)})
    ingest(spark, src, out, [PREFIX, other], **SPAN)
    kind = lambda t: dict(spark.read.parquet(f"{out}/asset_class=us_options_opra/data_type={t}").dtypes)["px"]
    assert (kind("quotes_v1"), kind("trades_v1")) == ("bigint", "string")


def test_unsigned_ranges_and_fine_timestamps(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, {**obj(17, "ticker,px\nA,255\n"), **obj(18, "ticker,px\nA,256\n"), **obj(19, "ticker,px\nA,-1\n"), **obj(20, "ticker,px\nA,1.6\n")})
    run = ingest(spark, src, out, PREFIX, column_types={"px": "uint8"}, **SPAN)
    assert statuses(run) == {"2025-03-17.csv.gz": "written", "2025-03-18.csv.gz": "failed", "2025-03-19.csv.gz": "failed", "2025-03-20.csv.gz": "failed"}


def test_unknown_column_is_reported_once_per_file(spark, tmp_path):
    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, {**obj(17, "ticker,px\nA,1\n"), **obj(18, "ticker,px\nB,1\n")})
    run = ingest(spark, src, out, PREFIX, columns=["nope"], **SPAN)
    assert {r.status for r in run.result.collect()} == {"failed"}
    assert all("nope" in r.error for r in run.result.collect())


def test_user_filter_sees_each_row_once_and_staging_goes(spark, tmp_path):
    import os

    from flatlake.session import checkpoint_root

    src, out = str(tmp_path / "b"), str(tmp_path / "o")
    put_all(src, obj(17, "ticker,px\n" + "".join(f"T{i},{i}\n" for i in range(100))))
    seen = spark.sparkContext.accumulator(0)

    def keep(df):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return df.mapInArrow(run, df.schema)

    root = checkpoint_root(spark).removeprefix("file:") + "/flatlake"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    ingest(spark, src, out, PREFIX, row_filter=keep, row_filter_id="all", **SPAN)
    assert seen.value == 100
    assert set(os.listdir(root)) - before == set()


def test_manifest_snapshots_keep_the_log(spark, tmp_path):
    root = str(tmp_path / "o")
    entry = lambda rel, etag: spark.createDataFrame(
        [(rel, rel, etag, 1, 1, "s", "parquet", True, "x")],
        "rel string, key string, etag string, size bigint, rows bigint, signature string, format string, written boolean, location string")
    M.append_entries(spark, root, entry("a", "1"), M.new_run_id())
    M.append_entries(spark, root, entry("b", "1"), M.new_run_id())
    assert M.compact(spark, root) == 2
    assert M.log_files_to_read(spark, root) == 0
    M.append_entries(spark, root, entry("a", "2"), M.new_run_id())
    M.forget(spark, root, ["b"])
    assert {(r.rel, r.etag) for r in M.read_current(spark, root).collect()} == {("a", "2")}
    assert M.compact(spark, root) == 1
    assert {(r.rel, r.etag) for r in M.read_current(spark, root).collect()} == {("a", "2")}
