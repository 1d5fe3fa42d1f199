from pyspark.sql import functions as F

from flatlake.plans import manifest as M
from flatlake.plans.incremental import duplicate_rels, new_files, plan_actions
from flatlake.plans.paths import bad_rels, render_path, validate_template, with_rel

import pytest
from datetime import date

SIG = "sig"


def test_truth_table(spark):
    files = spark.createDataFrame(
        [("a", "e1"), ("b", "e1"), ("c", "e1"), ("d", "e1"), ("e", "e1"), ("f", "e1"), ("g", "e1")],
        "rel string, etag string",
    )
    current = spark.createDataFrame(
        [("a", "old", SIG, True), ("b", "e1", "other", True), ("c", "e1", SIG, False),
         ("d", "e1", SIG, True), ("e", "e1", SIG, True)],
        "rel string, etag string, signature string, written boolean",
    )
    outputs = spark.createDataFrame([("d",), ("f",)], "rel string")
    got = {r.rel: (r.action, r.reason) for r in plan_actions(files, current, outputs, SIG).collect()}
    assert got == {
        "a": ("pull", "changed"), "b": ("pull", "changed"), "c": ("skip", "up to date"),
        "d": ("skip", "up to date"), "e": ("pull", "output missing"), "f": ("skip", "exists"),
        "g": ("pull", "new"),
    }
    forced = {r.rel: r.action for r in plan_actions(files, current, outputs, SIG, force=True).collect()}
    assert set(forced.values()) == {"pull"}
    assert sorted(r.rel for r in new_files(files, current).collect()) == ["f", "g"]


def test_partition_groups_pull_together(spark):
    files = spark.createDataFrame([("a", "e", "p1"), ("b", "e", "p1"), ("c", "e", "p2")], "rel string, etag string, location string")
    current = spark.createDataFrame([("a", "e", SIG, True), ("c", "e", SIG, True)], "rel string, etag string, signature string, written boolean")
    outputs = spark.createDataFrame([("a",), ("b",), ("c",)], "rel string")
    got = {r.rel: r.action for r in plan_actions(files, current, outputs, SIG, group_cols=["location"]).collect()}
    assert got == {"a": "skip", "b": "skip", "c": "skip"}
    files2 = files.withColumn("etag", F.when(F.col("rel") == "b", "new").otherwise(F.col("etag")))
    current2 = current.union(spark.createDataFrame([("b", "e", SIG, True)], current.schema))
    got2 = {r.rel: r.action for r in plan_actions(files2, current2, outputs, SIG, group_cols=["location"]).collect()}
    assert got2 == {"a": "pull", "b": "pull", "c": "skip"}


def test_render_path():
    d = date(2025, 3, 17)
    assert render_path("{dataset}/{year}/{month}/{date}.{ext}", "us_stocks_sip/trades_v1", d, "parquet") == \
        "us_stocks_sip/trades_v1/2025/03/2025-03-17.parquet"
    assert render_path("{name}/{filename}", "us_stocks_sip/trades_v1", d, "", "2025-03-17.csv.gz") == "trades/2025-03-17.csv.gz"
    assert render_path("{name}/{date}.{ext}", "a/b_v2", d, "", "2025-03-17.csv.gz") == "b/2025-03-17.csv.gz"
    for bad in ("/{date}", "../{date}", "{nope}", "{}", "  "):
        with pytest.raises(ValueError):
            validate_template(bad)


def test_rel_column_and_duplicates(spark):
    cat = spark.createDataFrame(
        [("us_stocks_sip/trades_v1", date(2025, 3, 17), "2025-03-17.csv.gz"),
         ("us_stocks_sip/trades_v1", date(2025, 3, 17), "2025-03-17.p00001.csv.gz")],
        "dataset string, file_date date, filename string",
    )
    r = with_rel(cat, "{dataset}/{year}/{month}/{date}.{ext}", "parquet")
    assert duplicate_rels(r).count() == 1
    assert duplicate_rels(with_rel(cat, "{dataset}/{filename}", "")).count() == 0
    assert bad_rels(with_rel(cat, "{name}/{filename}", "")).count() == 0
    evil = spark.createDataFrame([("../x", date(2025, 1, 1), "f")], cat.schema)
    assert bad_rels(with_rel(evil, "{dataset}/{filename}", "")).count() == 1


def test_manifest_log(spark, tmp_path):
    root = str(tmp_path / "out")
    assert M.read_current(spark, root).count() == 0
    e = spark.createDataFrame(
        [("r1", "k1", "e1", 10, 5, SIG, "parquet", True, "loc1"), ("r2", "k2", "e2", 10, 0, SIG, "parquet", False, "loc2")],
        "rel string, key string, etag string, size bigint, rows bigint, signature string, format string, written boolean, location string",
    )
    M.append_entries(spark, root, e, "run-1")
    cur = {r.rel: r for r in M.read_current(spark, root).collect()}
    assert set(cur) == {"r1", "r2"} and cur["r2"].written is False
    M.append_entries(spark, root, e.filter("rel = 'r1'").withColumn("etag", F.lit("e9")), "run-2")
    assert {r.rel: r.etag for r in M.read_current(spark, root).collect()}["r1"] == "e9"
    M.forget(spark, root, ["r1"])
    assert [r.rel for r in M.read_current(spark, root).collect()] == ["r2"]


def test_manifest_compact(spark, tmp_path):
    root = str(tmp_path / "out")
    e = spark.createDataFrame(
        [("r1", "k1", "e1", 10, 5, SIG, "parquet", True, "loc1"), ("r2", "k2", "e2", 10, 0, SIG, "parquet", False, "loc2")],
        "rel string, key string, etag string, size bigint, rows bigint, signature string, format string, written boolean, location string",
    )
    M.append_entries(spark, root, e, "run-1")
    M.append_entries(spark, root, e.filter("rel = 'r1'"), "run-2")
    M.forget(spark, root, ["r2"])
    assert M.read_log(spark, root).count() == 4
    assert M.compact(spark, root) == 1
    assert M.read_log(spark, root).count() == 1
    assert [r.rel for r in M.read_current(spark, root).collect()] == ["r1"]


def test_corrupt_manifest_raises(spark, tmp_path):
    import os

    root = str(tmp_path / "out")
    os.makedirs(os.path.join(root, M.MANIFEST_DIR))
    with open(os.path.join(root, M.MANIFEST_DIR, "part-0.parquet"), "wb") as fh:
        fh.write(b"not parquet at all")
    with pytest.raises(Exception):
        M.read_current(spark, root).collect()
