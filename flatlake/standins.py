"""The library's operators run over the driver's tables.

The test tables hold no tickers or flat files, so each operator runs on a
stand-in built from them (and grows with them):

* dataset  = ``o_orderstatus`` -> asset class, ``o_orderpriority`` -> data type
* file     = one (dataset, ``o_orderdate``) group of ``orders`` (an object key)
* events   = a quotes-like dataset per ``event_type``, one file per day
* ticker   = ``p_brand`` (prefix ``Brand#1`` also matches ``Brand#17``)
* epoch ns = microseconds of ``ts`` * 1000 (+ ``event_id % 1000`` ns)

I/O operators (scan, sinks, publish, streaming, ingest) export a table to a
fresh folder under the shared checkpoint folder and read it back.
Each function takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL lives in :mod:`flatlake.standins_sql`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import keys as K
from .functions.epoch import (
    convert_epochs,
    epoch_to_timestamp,
    floor_div,
    iso_from_epoch_ns,
    iso_from_timestamp,
    resolve_timestamp_columns,
)
from .functions.signature import filter_signature_col
from .functions.tickers import extract_underlying as underlying_col
from .ingest import ingest, ingest_underlying
from .operators.aggregates import rows_per_file as rows_per_file_op, status_counts
from .operators.filters import arrow_row_filter, filter_by_sets, filter_tickers, project as project_op
from .operators.union import union_widened
from .plans import manifest as M
from .plans.incremental import new_files, plan_actions
from .plans.paths import with_rel
from .session import delete_path, ensure_utc, scratch_path, session_conf, touch
from .sinks.formats import get_format, read_output
from .sinks.raw import copy_files, md5_files
from .sources import catalog as C
from .sources.csv_scan import ROW_BAD, scan_csv
from .sources.export import export_daily_files
from .sources.listing import list_keys, list_prefixes, listing as list_objects
from .sources.schema import infer_file_schemas, schema_rows
from .streaming.available_now import stream_csv_available_now, stream_ingest

TODAY_ORDERS = date(2001, 12, 31)
TODAY_EVENTS = date(2024, 2, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def present(df: DataFrame) -> DataFrame:
    """DATE columns as ISO text, TIMESTAMP as TIMESTAMP_NTZ (engine-neutral output)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --------------------------------------------------------------------------- #
# Stand-in listings and catalogs
# --------------------------------------------------------------------------- #


def orders_prefix() -> F.Column:
    asset = F.element_at(
        F.array(F.lit("us_stocks_sip"), F.lit("us_options_opra"), F.lit("global_crypto")),
        F.instr(F.lit("FO"), F.col("o_orderstatus")) + F.when(F.col("o_orderstatus").isin("F", "O"), 0).otherwise(3),
    )
    dtype = F.element_at(
        F.array(*[F.lit(t) for t in ("trades_v1", "quotes_v1", "minute_aggs_v1", "day_aggs_v1", "day_aggs_v2")]),
        F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(5)),
    )
    return F.concat(asset, F.lit("/"), dtype)


def orders_keys(orders: DataFrame) -> DataFrame:
    """Every order mapped to the object key of its (dataset, day) file.

    Orders with ``o_orderkey % 50 = 0`` land in an undated notes object of the
    month instead (the catalog must drop those).
    """
    d = F.col("o_orderdate").cast("date")
    name = F.when(
        F.col("o_orderkey") % 50 == 0, F.concat(F.lit("notes-"), F.date_format(d, "yyyyMMdd"), F.lit(".txt"))
    ).otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(".csv.gz")))
    key = F.concat(orders_prefix(), F.lit("/"), F.date_format(d, "yyyy/MM"), F.lit("/"), name)
    return orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", orders_prefix().alias("prefix"), d.alias("o_date"), key.alias("key")
    )


def _listing_of(rows: DataFrame, group_cols: list, id_col: str) -> DataFrame:
    """One listing row per stand-in object.

    Rows are grouped on cheap columns and the key is carried as ``min(key)``
    (constant within a group), so predicates on parsed keys stay above the
    aggregate instead of being evaluated on every source row.
    """
    return (
        rows.groupBy(*group_cols)
        .agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("size"), F.min(id_col).alias("_k"))
        .select(
            "key",
            F.concat_ws("-", F.col("size").cast("string"), F.col("_k").cast("string")).alias("etag"),
            F.col("size").cast("bigint").alias("size"),
            F.lit(None).cast("timestamp").alias("last_modified"),
        )
    )


def orders_listing(orders: DataFrame) -> DataFrame:
    """``listing(key, etag, size, last_modified)`` of the stand-in objects."""
    ok = orders_keys(orders).withColumn("_notes", F.col("o_orderkey") % 50 == 0)
    return _listing_of(ok, ["o_orderstatus", "prefix", "o_date", "_notes"], "o_orderkey")


def orders_catalog(spark, sf_dir) -> DataFrame:
    return C.build_catalog(orders_listing(table(spark, sf_dir, "orders")))


def events_prefix() -> F.Column:
    return F.concat(F.lit("us_events/"), F.col("event_type"), F.lit("_v1"))


def events_listing(events: DataFrame) -> DataFrame:
    d = F.col("ts").cast("date")
    rows = events.select("event_type", d.alias("_d"), "event_id", K.key_for_date(events_prefix(), d, "csv.gz").alias("key"))
    return _listing_of(rows, ["event_type", "_d"], "event_id")


def events_catalog(spark, sf_dir) -> DataFrame:
    return C.build_catalog(events_listing(table(spark, sf_dir, "events")))


EVENT_DATASETS = [f"us_events/{t}_v1" for t in ("click", "error", "purchase", "signup", "view")]


# --------------------------------------------------------------------------- #
# Filters and projections
# --------------------------------------------------------------------------- #


def q_filter_in_or_prefix(spark, sf_dir):
    return filter_tickers(table(spark, sf_dir, "part"), "p_brand", ["Brand#2"], ["Brand#1"])


def q_filter_in(spark, sf_dir):
    return filter_tickers(table(spark, sf_dir, "part"), "p_brand", ["Brand#2", "Brand#25"])


def q_filter_prefix(spark, sf_dir):
    return filter_tickers(table(spark, sf_dir, "part"), "p_brand", prefixes=["Brand#1", "Brand#3"])


def q_filter_cast_prefix(spark, sf_dir):
    return filter_tickers(table(spark, sf_dir, "orders"), "o_orderkey", prefixes=["12"])


def q_filter_cast_double(spark, sf_dir):
    return filter_tickers(table(spark, sf_dir, "part"), "p_retailprice", ["901", "950.5"], ["99"])


def q_project(spark, sf_dir):
    return present(project_op(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderdate", "o_orderkey", "o_totalprice"]))


def _quantity_over_25(batch):
    import pyarrow.compute as pc

    return batch.filter(pc.greater(batch.column("l_quantity"), 25))


def q_row_filter(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").transform(arrow_row_filter(_quantity_over_25))


# --------------------------------------------------------------------------- #
# Epochs and timestamps
# --------------------------------------------------------------------------- #


def _events_epochs(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return ev.select("event_id", "user_id", "event_type", "value", us.alias("_us"))


def q_epoch_to_ts(spark, sf_dir):
    ev = _events_epochs(spark, sf_dir)
    epochs = ev.select(
        "event_id",
        floor_div("_us", 1_000_000).alias("e_s"),
        floor_div("_us", 1_000).alias("e_ms"),
        F.col("_us").alias("e_us"),
        (F.col("_us") * 1000 + F.col("event_id") % 1000).alias("e_ns"),
    )
    return present(epochs.select(
        "event_id",
        epoch_to_timestamp("e_s", "s").alias("ts_s"),
        epoch_to_timestamp("e_ms", "ms").alias("ts_ms"),
        epoch_to_timestamp("e_us", "us").alias("ts_us"),
        epoch_to_timestamp("e_ns", "ns").alias("ts_ns"),
    ))


def q_epoch_auto(spark, sf_dir):
    ev = _events_epochs(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "value",
        (F.col("_us") * 1000).alias("sip_timestamp"),
        (F.col("_us") * 1000 + F.col("event_id") % 1000).alias("participant_timestamp"),
    )
    cols = resolve_timestamp_columns(ev.schema, "auto")
    return present(convert_epochs(ev, cols, "ns", keep_ns=True))


def q_iso_timestamp(spark, sf_dir):
    ev = _events_epochs(spark, sf_dir).select(
        "event_id",
        (F.col("_us") * 1000 + F.col("event_id") % 1000).alias("n"),
        F.timestamp_micros("_us").alias("t"),
    )
    return ev.select(
        "event_id",
        iso_from_epoch_ns("n").alias("iso_ns"),
        iso_from_timestamp("t", "ms").alias("iso_ms"),
        iso_from_timestamp("t", "s").alias("iso_s"),
    )


def q_extract_underlying(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    option = F.concat(
        F.lit("O:"),
        F.upper(F.regexp_replace("p_type", "[^A-Za-z]", "")),
        F.lpad((F.col("p_partkey") % 1000000).cast("string"), 6, "0"),
        F.when(F.col("p_size") % 2 == 0, F.lit("C")).otherwise(F.lit("P")),
        F.lpad(F.round(F.col("p_retailprice") * 1000).cast("bigint").cast("string"), 8, "0"),
    )
    ticker = (
        F.when(F.col("p_partkey") % 3 == 0, option)
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("O:"), F.col("p_brand")))
        .otherwise(F.col("p_name"))
    )
    t = p.select("p_partkey", ticker.alias("ticker"))
    return t.select("p_partkey", "ticker", underlying_col("ticker").alias("underlying"))


# --------------------------------------------------------------------------- #
# Keys, datasets, catalog
# --------------------------------------------------------------------------- #


def q_dataset_parts(spark, sf_dir):
    lst = orders_listing(table(spark, sf_dir, "orders"))
    ds = K.dataset_of_key("key")
    return lst.select(
        "key",
        ds.alias("dataset"),
        K.asset_class(ds).alias("asset_class"),
        K.data_type(ds).alias("data_type"),
        K.dataset_name(ds).alias("name"),
        K.basename("key").alias("filename"),
        K.extension("key").alias("extension"),
        K.date_from_key("key").alias("file_date"),
    ).transform(present)


def q_key_for_date(spark, sf_dir):
    ok = orders_keys(table(spark, sf_dir, "orders")).select("prefix", "o_date").distinct()
    return present(ok.select(
        "prefix",
        F.col("o_date").alias("file_date"),
        K.month_prefix("prefix", "o_date").alias("month_prefix"),
        K.key_for_date("prefix", "o_date", "csv.gz").alias("key"),
    ))


def q_render_path(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    cat = with_rel(cat, "{dataset}/{year}/{month}/{date}.{ext}", "parquet", "rel_default")
    cat = with_rel(cat, "{asset_class}/{name}/{year}/{day}/{date}_{data_type}.{ext}", "", "rel_custom")
    cat = with_rel(cat, "{name}/{filename}", "", "rel_raw")
    return cat.select("key", "rel_default", "rel_custom", "rel_raw")


def q_iter_months(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    span = o.groupBy("o_orderpriority").agg(
        F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")
    )
    return span.select("o_orderpriority", K.iter_months("lo", "hi").alias("m")).select(
        "o_orderpriority", F.date_format("m", "yyyy-MM").alias("month")
    )


def q_resolve_dataset(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    asset = F.element_at(
        F.array(*[F.lit(x) for x in ("stocks", "options", "indices", "forex", "crypto", "bogus")]),
        (F.col("user_id") % 6 + 1).cast("int"),
    )
    dtype = (
        F.when(F.col("event_type") == "view", F.lit("trades"))
        .when(F.col("event_type") == "click", F.lit("quotes"))
        .otherwise(F.col("event_type"))
    )
    name = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(F.lit(" /"), asset, F.lit("/"), dtype, F.lit("/ ")))
        .otherwise(F.concat(asset, F.lit("/"), dtype))
    )
    names = ev.select(name.alias("name")).distinct()
    return C.resolve_names(spark, names, "name")


def q_datasets_without_files(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rg = table(spark, sf_dir, "region")
    requested = ev.select(F.col("event_type").alias("dataset")).union(
        rg.select(F.lower("r_name").alias("dataset"))
    ).distinct()
    selected = ev.filter(
        F.col("ts").cast("date").between(F.lit(date(2024, 1, 5)), F.lit(date(2024, 1, 10)))
    ).select(F.col("event_type").alias("dataset"))
    return C.datasets_without_files(requested, selected)


def q_signature(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    g = o.groupBy("o_orderpriority").agg(
        F.collect_set("o_orderstatus").alias("vals"),
        F.collect_set(F.substring(F.col("o_custkey").cast("string"), 1, 1)).alias("prefs"),
    )
    sig = filter_signature_col("o_orderstatus", F.col("vals"), F.col("prefs"))
    return g.select("o_orderpriority", sig.alias("signature")).withColumn(
        "signature_sha", F.sha2("signature", 256)
    )


def q_catalog(spark, sf_dir):
    return present(orders_catalog(spark, sf_dir).select(*C.CATALOG_COLUMNS))


def q_rows_per_file(spark, sf_dir):
    ok = orders_keys(table(spark, sf_dir, "orders")).filter(F.col("o_orderstatus") == "F")
    return rows_per_file_op(ok, "key")


def q_date_range(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    sel = C.select_date_range(
        cat, ["us_stocks_sip/trades_v1", "us_options_opra/quotes_v1", "global_crypto/day_aggs_v2"],
        date(1996, 3, 15), date(1996, 6, 10),
    )
    return present(sel.select("key", "dataset", "file_date"))


def q_latest_one(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    sel = C.select_latest(cat, ["us_stocks_sip/trades_v1"], 1, TODAY_ORDERS)
    return present(sel.select("key", "dataset", "file_date"))


def q_latest_n(spark, sf_dir):
    cat = events_catalog(spark, sf_dir)
    sel = C.select_latest(cat, EVENT_DATASETS, 3, TODAY_EVENTS)
    # the place of each file in the selection's own order (a handful of rows)
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return present(sel.coalesce(1).withColumn("place", place).select("key", "dataset", "file_date", "place"))


def q_list_datasets(spark, sf_dir):
    lst = orders_listing(table(spark, sf_dir, "orders"))
    return C.datasets_frame(spark, list_prefixes(lst))


def q_list_dates(spark, sf_dir):
    lst = orders_listing(table(spark, sf_dir, "orders"))
    return list_keys(lst, "us_stocks_sip/trades_v1/1997/03")


def q_union_datasets(spark, sf_dir):
    cat = orders_catalog(spark, sf_dir)
    names = ["stocks/trades", "us_stocks_sip/trades_v1", "options/quotes", "crypto/day_aggs_v2"]
    prefixes = list(dict.fromkeys(C.resolve_dataset(n) for n in names))
    sel = C.select_date_range(cat, prefixes, date(1997, 1, 1), date(1997, 12, 31))
    return present(sel.select("key", "dataset", "file_date"))


def q_union_schemas(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("tag")
    )
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("n"), F.col("o_orderstatus").alias("tag2")
    )
    return union_widened([li, od])


# --------------------------------------------------------------------------- #
# Plan and manifest
# --------------------------------------------------------------------------- #

RUN_SIGNATURE = "parquet|zstd||columns=*;types=;ts=auto;unit=ns|"


def _planned_files(spark, sf_dir) -> DataFrame:
    cat = orders_catalog(spark, sf_dir)
    return with_rel(cat, "{dataset}/{year}/{month}/{date}.{ext}", "parquet")


def _manifest_standin(files: DataFrame) -> DataFrame:
    """Current entries for files with ``size % 4 != 0``; some stale ETags/signatures."""
    return files.filter(F.col("size") % 4 != 0).select(
        "rel",
        F.when(F.col("size") % 5 == 0, F.concat(F.lit("old-"), F.col("etag"))).otherwise(F.col("etag")).alias("etag"),
        F.when(F.col("dir_month") == 12, F.lit("other")).otherwise(F.lit(RUN_SIGNATURE)).alias("signature"),
        (F.col("size") % 3 != 0).alias("written"),
    )


def _outputs_standin(files: DataFrame) -> DataFrame:
    return files.filter(F.col("size") % 2 == 0).select("rel")


def _plan(spark, sf_dir) -> DataFrame:
    files = _planned_files(spark, sf_dir)
    return plan_actions(files, _manifest_standin(files), _outputs_standin(files), RUN_SIGNATURE)


def q_plan_incremental(spark, sf_dir):
    return _plan(spark, sf_dir).select("rel", "key", "action", "reason")


def q_plan_status_counts(spark, sf_dir):
    return _plan(spark, sf_dir).groupBy("action", "reason").agg(F.count(F.lit(1)).alias("files"))


def q_plan_new_files(spark, sf_dir):
    files = _planned_files(spark, sf_dir)
    return new_files(files, _manifest_standin(files)).select("rel", "key")


def _manifest_log(spark, sf_dir) -> DataFrame:
    files = _planned_files(spark, sf_dir)
    base = F.to_timestamp(F.concat(F.date_format("file_date", "yyyy-MM-dd"), F.lit(" 06:00:00")))
    run1 = files.select(
        "rel", "key", "etag", "size", F.col("size").alias("rows"), F.lit(RUN_SIGNATURE).alias("signature"),
        F.lit("parquet").alias("format"), F.lit(True).alias("written"),
        (base + F.expr("INTERVAL 1 DAY")).alias("completed_at"), F.lit(None).cast("string").alias("location"),
        F.lit("run-1").alias("run_id"), F.lit("record").alias("op"),
    )
    run2 = files.filter(F.col("size") % 2 == 0).select(
        "rel", "key", F.concat(F.lit("v2-"), F.col("etag")).alias("etag"), "size",
        (F.col("size") * 2).alias("rows"), F.lit(RUN_SIGNATURE).alias("signature"),
        F.lit("parquet").alias("format"), (F.col("size") % 3 != 0).alias("written"),
        (base + F.expr("INTERVAL 2 DAY")).alias("completed_at"), F.lit(None).cast("string").alias("location"),
        F.lit("run-2").alias("run_id"), F.lit("record").alias("op"),
    )
    run3 = files.filter(F.dayofmonth("file_date") % 7 == 0).select(
        "rel", F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("bigint").alias("rows"),
        F.lit(None).cast("string").alias("signature"), F.lit(None).cast("string").alias("format"),
        F.lit(None).cast("boolean").alias("written"), (base + F.expr("INTERVAL 2 DAY")).alias("completed_at"),
        F.lit(None).cast("string").alias("location"), F.lit("run-3").alias("run_id"), F.lit("forget").alias("op"),
    )
    return run1.unionByName(run2).unionByName(run3)


def q_manifest_current(spark, sf_dir):
    cur = M.current_entries(_manifest_log(spark, sf_dir))
    return present(cur.select("rel", "key", "etag", "rows", "written", "completed_at", "run_id"))


def q_manifest_forget(spark, sf_dir):
    log = _manifest_log(spark, sf_dir)
    cur = M.current_entries(log)
    return log.select("rel").distinct().join(cur.select("rel"), "rel", "left_anti")


def q_empty_partitions(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cat = events_catalog(spark, sf_dir)
    key = K.key_for_date(events_prefix(), F.col("ts").cast("date"), "csv.gz")
    kept = ev.filter(F.col("value") > 250).select(key.alias("key"))
    counts = rows_per_file_op(kept, "key")
    return (
        cat.join(counts, "key", "left")
        .select("key", F.coalesce("rows", F.lit(0)).alias("rows"))
        .filter(F.col("rows") == 0)
    )


# --------------------------------------------------------------------------- #
# Sinks, publish, scan
# --------------------------------------------------------------------------- #


def _events_for_sink(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    df = ev.select("event_id", "event_type", "value", (us * 1000 + F.col("event_id") % 1000).alias("ts"), "props")
    return convert_epochs(df, ["ts"], "ns", keep_ns=True)


def _sink_roundtrip(spark, sf_dir, fmt: str, compression="default") -> DataFrame:
    ensure_utc(spark)
    path = scratch_path(spark, f"sink-{fmt}")
    get_format(fmt).write(_events_for_sink(spark, sf_dir), path, compression, ["event_type"])
    back = read_output(spark, fmt, path)
    if fmt in ("parquet", "feather"):
        return back.select(
            F.col("event_id").cast("bigint"), F.col("event_type").cast("string"), F.col("value").cast("double"),
            F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("ts_ns").cast("bigint"), "props",
        )
    return back.select(
        F.col("event_id").cast("bigint"), F.col("event_type").cast("string"), F.col("value").cast("double"),
        F.col("ts").alias("ts_text"), "props",
    )


def q_sink_parquet(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "parquet")


def q_sink_feather(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "feather")


def q_sink_csv(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "csv")


def q_sink_csv_gz(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "csv.gz")


def q_sink_jsonl(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "jsonl")


def q_sink_jsonl_gz(spark, sf_dir):
    return _sink_roundtrip(spark, sf_dir, "jsonl.gz")


def q_republish_overwrite(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day")
    )
    path = scratch_path(spark, "republish")
    fmt = get_format("parquet")
    fmt.write(ev, path, "default", ["day"])
    redo = ev.filter(F.col("day") == "2024-01-15").withColumn("value", F.col("value") * 2)
    fmt.write(redo, path, "default", ["day"])
    back = spark.read.option("basePath", path).schema(
        "event_id bigint, event_type string, value double, day string"
    ).parquet(path)
    return back


def _orders_csv_export(spark, sf_dir, fmt="csv.gz") -> str:
    path = scratch_path(spark, "orders-export")
    o = table(spark, sf_dir, "orders")
    # gzip files do not split: as many files as the session has task slots
    get_format(fmt).write(o.repartition(spark.sparkContext.defaultParallelism), path, "default", [])
    return path


def _export_files(spark, path) -> DataFrame:
    lst = list_objects(spark, path).filter(F.col("key").endswith(".gz"))
    return lst.select("key", "path")


def q_scan_csv(spark, sf_dir):
    ensure_utc(spark)
    path = _orders_csv_export(spark, sf_dir)
    files = _export_files(spark, path)
    groups, _, failed = infer_file_schemas(spark, files)
    if failed or len(groups) != 1:
        raise RuntimeError(f"unexpected export state: {failed}, {len(groups)} header groups")
    (g,) = groups.values()
    paths = [r.path for r in files.collect()]
    return scan_csv(spark, paths, g["schema"]).drop(ROW_BAD, "_path")


def _schema_query(spark, sf_dir, column_types=None):
    path = _orders_csv_export(spark, sf_dir)
    files = _export_files(spark, path)
    groups, _, _ = infer_file_schemas(spark, files, column_types)
    (g,) = groups.values()
    return schema_rows(spark, g["schema"])


def q_infer_schema(spark, sf_dir):
    return _schema_query(spark, sf_dir)


def q_type_override(spark, sf_dir):
    from .sources.schema import parse_column_types

    return _schema_query(spark, sf_dir, parse_column_types(["o_custkey=int32", "o_totalprice=float32", "o_orderstatus=string"]))


def q_failed_files(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus",
        F.when(F.col("l_orderkey") % 997 == 0, F.lit("n/a-x")).otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
    )
    path = scratch_path(spark, "failed-export")
    get_format("csv.gz").write(li, path, "default", ["l_returnflag", "l_linestatus"])
    files = list_objects(spark, path).filter(F.col("key").endswith(".gz")).select("key", "path")
    from .sources.schema import parse_column_types

    groups, _, _ = infer_file_schemas(spark, files, parse_column_types(["l_quantity=float64"]))
    (g,) = groups.values()
    scanned = scan_csv(spark, [r.path for r in files.collect()], g["schema"])
    part = F.regexp_extract("_path", r"l_returnflag=([^/]+)/l_linestatus=([^/]+)/", 1)
    part2 = F.regexp_extract("_path", r"l_returnflag=([^/]+)/l_linestatus=([^/]+)/", 2)
    per_file = scanned.groupBy("_path").agg(
        F.sum(F.col(ROW_BAD).cast("int")).alias("bad_rows"), F.count(F.lit(1)).alias("rows")
    )
    return per_file.groupBy(part.alias("l_returnflag"), part2.alias("l_linestatus")).agg(
        F.sum("bad_rows").cast("bigint").alias("bad_rows"),
        F.sum("rows").cast("bigint").alias("total_rows"),
        F.sum((F.col("bad_rows") > 0).cast("int")).cast("bigint").alias("_failed_files"),
    ).drop("_failed_files")


def q_sink_raw(spark, sf_dir):
    """Byte-identical copies of exported files: equal digests, and the copies' rows read back."""
    path = _orders_csv_export(spark, sf_dir)
    files = _export_files(spark, path)
    dest = scratch_path(spark, "raw-copy")
    jobs = files.select("key", "path", F.concat(F.lit(dest + "/"), F.col("key")).alias("dest"))
    copied = copy_files(jobs, partitions=spark.sparkContext.defaultParallelism)
    digests = copied.select("key", "md5").join(md5_files(files).withColumnRenamed("md5", "source"), "key", "left")
    if digests.filter(~F.col("md5").eqNullSafe(F.col("source"))).limit(1).count():
        raise RuntimeError("a copy differs from its source")
    groups, _, _ = infer_file_schemas(spark, _export_files(spark, dest))
    (g,) = groups.values()
    return scan_csv(spark, [r.path for r in _export_files(spark, dest).collect()], g["schema"]).drop(ROW_BAD, "_path")


def q_sink_raw_ranges(spark, sf_dir):
    """As ``sink_raw``, every file in ranges of a third of the mean file: the copies' own digests and rows."""
    path = _orders_csv_export(spark, sf_dir)
    files = _export_files(spark, path)
    dest = scratch_path(spark, "range-copy")
    sized = files.join(list_objects(spark, path).select("key", "size"), "key")
    jobs = sized.select("key", "path", F.concat(F.lit(dest + "/"), F.col("key")).alias("dest"), "size")
    third = int(sized.agg(F.avg("size")).first()[0] // 3) + 1
    failed = copy_files(jobs, spark.sparkContext.defaultParallelism, part_bytes=third).filter("error is not null").limit(1).collect()
    if failed:
        raise RuntimeError(f"copy failed: {failed}")
    copies = _export_files(spark, dest)
    digests = md5_files(files).withColumnRenamed("md5", "source").join(md5_files(copies), "key", "left")
    if digests.filter(~F.col("md5").eqNullSafe(F.col("source"))).limit(1).count():
        raise RuntimeError("a copy differs from its source")
    groups, _, _ = infer_file_schemas(spark, copies)
    (g,) = groups.values()
    return scan_csv(spark, [r.path for r in copies.collect()], g["schema"]).drop(ROW_BAD, "_path")


def q_listing(spark, sf_dir):
    """Objects per folder as listed, and the rows of exactly the listed objects."""
    path = scratch_path(spark, "listing")
    get_format("csv").write(table(spark, sf_dir, "orders"), path, "default", ["o_orderstatus"])
    objects = list_objects(spark, path).filter(F.col("key").endswith(".csv"))
    folder = lambda key: F.regexp_extract(key, "o_orderstatus=([^/]+)/", 1)
    seen = objects.groupBy(folder("key").alias("folder")).agg((F.min("size") > 0).alias("filled"), F.countDistinct("etag").alias("etags"))
    listed = spark.read.option("header", True).csv([r["path"] for r in objects.select("path").collect()])
    rows = listed.groupBy(folder(F.col("_metadata.file_path")).alias("folder")).agg(F.count(F.lit(1)).alias("rows"))
    return seen.join(rows, "folder", "left").select("folder", "rows", "filled", (F.col("etags") > 0).alias("has_etag"))


def q_stream_available_now(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    src = scratch_path(spark, "stream-src")
    get_format("csv").write(ev, src, "default", ["day"])
    out = scratch_path(spark, "stream-out")
    schema = T.StructType([
        T.StructField("event_id", T.StringType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.StringType()),
    ])
    stream_csv_available_now(spark, src, schema, out, {"event_id": T.LongType(), "value": T.DoubleType()})
    return spark.read.parquet(out).select("event_id", "event_type", "value")


def q_ingest_events(spark, sf_dir):
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = ev.select(
        events_prefix().alias("dataset"),
        F.col("ts").cast("date").alias("file_date"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        "value",
        (us * 1000 + F.col("event_id") % 1000).alias("sip_timestamp"),
    )
    src = scratch_path(spark, "vendor")
    export_daily_files(spark, rows, src, ["ticker", "value", "sip_timestamp"])
    out = scratch_path(spark, "ingested")
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    run = ingest(
        spark, src, out, EVENT_DATASETS, start_date=first, end_date=last,
        ticker_prefixes=["U1"], columns=["ticker", "value", "sip_timestamp"],
        path_template="{dataset}/{date}/{filename}.{ext}",
    )
    bad = run.result.filter(F.col("status") == "failed").limit(1).collect()
    if bad:
        raise RuntimeError(f"ingest failed: {bad}")
    back = spark.read.parquet(out)
    return present(back.select(
        "ticker", "value", "sip_timestamp", "sip_timestamp_ns", F.col("data_type").cast("string"),
        F.col("file_date").cast("date"),
    ))


def q_stream_ingest_events(spark, sf_dir):
    """Catch-up streaming ingest of ``events`` exported as one daily file per day."""
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = ev.select(
        F.lit("us_events/stream_v1").alias("dataset"),
        F.col("ts").cast("date").alias("file_date"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        "event_type",
        "value",
        (us * 1000 + F.col("event_id") % 1000).alias("sip_timestamp"),
    )
    src = scratch_path(spark, "vendor-stream")
    export_daily_files(spark, rows, src, ["ticker", "event_type", "value", "sip_timestamp"])
    schema = T.StructType([
        T.StructField("ticker", T.StringType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("sip_timestamp", T.LongType()),
    ])
    out = scratch_path(spark, "stream-ingested")
    res = stream_ingest(spark, src, out, "us_events/stream_v1", schema, ticker_prefixes=["U1"])
    bad = res.filter(F.col("status") == "failed").limit(1).collect()
    if bad:
        raise RuntimeError(f"stream ingest failed: {bad}")
    back = spark.read.parquet(out)
    return present(back.select(
        "ticker", "event_type", "value", "sip_timestamp", "sip_timestamp_ns", F.col("file_date").cast("date"),
    ))


LINEITEM_DATASET = "us_stocks_sip/lineitem_v1"


def export_lineitem_files(spark, sf_dir) -> str:
    """``lineitem`` as one gzip CSV per ship date (a quotes-like dataset)."""
    li = table(spark, sf_dir, "lineitem")
    us = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    rows = li.select(
        F.lit(LINEITEM_DATASET).alias("dataset"),
        F.col("l_shipdate").cast("date").alias("file_date"),
        F.concat(F.lit("L"), F.col("l_partkey").cast("string")).alias("ticker"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        (us * 1000 + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sip_timestamp"),
    )
    src = scratch_path(spark, "vendor-lineitem")
    export_daily_files(spark, rows, src, ["ticker", "price", "size", "sip_timestamp"])
    return src


def ingest_lineitem_files(spark, src: str, out: str, force: bool = False):
    days = C.build_catalog(list_objects(spark, src)).agg(F.min("file_date"), F.max("file_date")).first()
    return ingest(
        spark, src, out, [LINEITEM_DATASET], start_date=days[0], end_date=days[1],
        path_template="{dataset}/{date}/{filename}.{ext}", force=force,
    )


def q_ingest_lineitem(spark, sf_dir):
    ensure_utc(spark)
    src = export_lineitem_files(spark, sf_dir)
    out = scratch_path(spark, "ingested-lineitem")
    run = ingest_lineitem_files(spark, src, out)
    bad = run.result.filter(F.col("status") == "failed").limit(1).collect()
    if bad:
        raise RuntimeError(f"ingest failed: {bad}")
    back = spark.read.parquet(out)
    return present(back.select(
        "ticker", "price", "size", "sip_timestamp", "sip_timestamp_ns", F.col("file_date").cast("date"),
    ))


# --------------------------------------------------------------------------- #
# Files one by one: siblings of a day, outcomes, types that drift
# --------------------------------------------------------------------------- #

SIBLINGS = "us_events/siblings_v1"
SIBLING_TEMPLATE = "{dataset}/{date}/{filename}.{ext}"


def _event_rows(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit(SIBLINGS).alias("dataset"), F.col("ts").cast("date").alias("file_date"), "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"), "value",
    )


def _checked(run) -> None:
    bad = run.result.filter(F.col("status") == "failed").limit(1).collect()
    if bad:
        raise RuntimeError(f"ingest failed: {bad}")


def q_ingest_two_files_per_day(spark, sf_dir):
    """Two files a day, ingested in two runs; then the first day's second file is republished (values doubled)."""
    ensure_utc(spark)
    rows = _event_rows(spark, sf_dir).withColumn("second", F.col("event_id") % 2 == 1)
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    src, out = scratch_path(spark, "siblings"), scratch_path(spark, "siblings-out")
    cols = ["event_id", "ticker", "value"]
    kw = dict(start_date=first, end_date=last, path_template=SIBLING_TEMPLATE, column_types={"value": "float64"})
    export_daily_files(spark, rows.filter("not second"), src, cols)
    _checked(ingest(spark, src, out, [SIBLINGS], **kw))
    export_daily_files(spark, rows.filter("second"), src, cols, suffix=".b")
    _checked(ingest(spark, src, out, [SIBLINGS], **kw))
    again = rows.filter(F.col("second") & (F.col("file_date") == F.lit(first))).withColumn("value", F.col("value") * 2)
    for key in [r["key"] for r in list_objects(spark, src).filter(F.col("key").contains(f"{first.isoformat()}.b")).collect()]:
        delete_path(spark, f"{src}/{key}")
    export_daily_files(spark, again, src, cols, suffix=".b")
    _checked(ingest(spark, src, out, [SIBLINGS], **kw))
    return present(spark.read.parquet(out).select(*cols, F.col("file_date").cast("date")))


def q_ingest_schema_drift(spark, sf_dir):
    """Days of whole numbers first, days with fractions in a later run: one table, one type."""
    ensure_utc(spark)
    rows = _event_rows(spark, sf_dir)
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    early = F.dayofmonth("file_date") <= 15
    src, out = scratch_path(spark, "drift"), scratch_path(spark, "drift-out")
    cols = ["event_id", "ticker", "value"]
    kw = dict(start_date=first, end_date=last, path_template=SIBLING_TEMPLATE)
    export_daily_files(spark, rows.filter(early).withColumn("value", F.floor("value")), src, cols)
    _checked(ingest(spark, src, out, [SIBLINGS], **kw))
    export_daily_files(spark, rows.filter(~early), src, cols)
    _checked(ingest(spark, src, out, [SIBLINGS], **kw))
    return present(spark.read.parquet(out).select(*cols, F.col("file_date").cast("date")))


OUTCOMES = "us_lines/monthly_v1"


def q_ingest_outcomes(spark, sf_dir):
    """Status and rows per file: one file a month of ``lineitem``; some are bad, some match nothing, one is empty.

    March files hold a quantity that is no number, July files hold no ticker
    that the filter keeps, and an empty object follows the last month.
    """
    ensure_utc(spark)
    li = table(spark, sf_dir, "lineitem")
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    rows = li.select(
        F.lit(OUTCOMES).alias("dataset"), month.alias("file_date"),
        F.when(F.month(month) == 7, F.lit("Z")).otherwise(F.concat(F.lit("L"), (F.col("l_partkey") % 3).cast("string"))).alias("ticker"),
        F.when((F.month(month) == 3) & (F.col("l_linenumber") == 1), F.lit("n/a-x")).otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
    )
    src, out = scratch_path(spark, "outcomes"), scratch_path(spark, "outcomes-out")
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    # one file a month whatever its size: outcomes are per file
    whole = rows.repartition("file_date")
    export_daily_files(spark, whole, src, ["ticker", "quantity"], split=False)
    nothing = date(last.year + 1, 1, 1)
    touch(spark, f"{src}/{OUTCOMES}/{nothing:%Y/%m}/{nothing.isoformat()}.csv")
    run = ingest(
        spark, src, out, [OUTCOMES], start_date=first, end_date=nothing, tickers=["L1"], column_types={"quantity": "float64"},
    )
    return run.result.select(F.date_format(K.date_from_key("key"), "yyyy-MM-dd").alias("file_date"), "status", "rows")


def q_ingest_status_counts(spark, sf_dir):
    """Files per outcome of the same run."""
    return status_counts(q_ingest_outcomes(spark, sf_dir))


# --------------------------------------------------------------------------- #
# Batch, stream and templates over one table; records and their order; large sets
# --------------------------------------------------------------------------- #

EVENT_ROW = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ticker", T.StringType()), T.StructField("value", T.DoubleType())])


def q_ingest_batch_then_stream(spark, sf_dir):
    """The first days by a batch, all days by the stream, the first day republished (values doubled), then another template."""
    ensure_utc(spark)
    rows = _event_rows(spark, sf_dir)
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    src, out = scratch_path(spark, "batch-stream"), scratch_path(spark, "batch-stream-out")
    cols = EVENT_ROW.names
    kw = dict(start_date=first, end_date=last, column_types={"value": "float64"})
    export_daily_files(spark, rows.filter(F.dayofmonth("file_date") <= 15), src, cols)
    _checked(ingest(spark, src, out, [SIBLINGS], path_template=SIBLING_TEMPLATE, **kw))
    export_daily_files(spark, rows.filter(F.dayofmonth("file_date") > 15), src, cols)
    streamed = lambda: stream_ingest(spark, src, out, SIBLINGS, EVENT_ROW)
    results = [streamed()]
    for key in [r["key"] for r in list_objects(spark, src).filter(F.col("key").contains(f"/{first.isoformat()}")).collect()]:
        delete_path(spark, f"{src}/{key}")
    export_daily_files(spark, rows.filter(F.col("file_date") == F.lit(first)).withColumn("value", F.col("value") * 2), src, cols)
    results.append(streamed())
    for res in results:
        if res.filter("status = 'failed'").limit(1).count():
            raise RuntimeError("stream ingest failed")
    _checked(ingest(spark, src, out, [SIBLINGS], path_template="again/" + SIBLING_TEMPLATE, **kw))
    return present(spark.read.parquet(out).select(*cols, F.col("file_date").cast("date")))


#: Splits small enough that the test tables' files have several.
SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "4096"}


def q_quoted_lines(spark, sf_dir):
    """``orders`` as plain and bz2 CSV with line ends and quotes inside a field, read over several tasks a file."""
    orders = table(spark, sf_dir, "orders")
    note = F.concat(F.col("o_orderpriority"), F.lit('\n"said", '), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("\n\nend")).otherwise(F.lit("")))
    rows = orders.select("o_orderkey", note.alias("note"), "o_totalprice")
    path, out = scratch_path(spark, "quoted"), scratch_path(spark, "quoted-out")
    for name, part, codec in (("plain", "o_orderkey % 2 = 0", None), ("packed", "o_orderkey % 2 = 1", "bz2")):
        get_format("csv").write(rows.filter(part), f"{path}/{name}", codec)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])
    with session_conf(spark, SMALL_SPLITS):
        files = [r["path"] for r in list_objects(spark, path).filter(F.col("key").rlike("[.]csv([.]bz2)?$")).collect()]
        scan_csv(spark, files, schema, multi_line=True).drop("_path").write.parquet(out)
    return spark.read.parquet(out)


def q_file_row_order(spark, sf_dir):
    """``lineitem`` written in order, several files a return flag; every row's place, from its number in its file."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice"
    )
    path, out = scratch_path(spark, "ordered"), scratch_path(spark, "ordered-out")
    get_format("csv").write(li, path, None, ["l_returnflag"], order_by=["l_orderkey", "l_linenumber"])
    schema = T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.LongType()), T.StructField("l_extendedprice", T.DoubleType()),
    ])
    with session_conf(spark, SMALL_SPLITS):
        files = [r["path"] for r in list_objects(spark, path).filter(F.col("key").endswith(".csv")).collect()]
        scan_csv(spark, files, schema, number="row").write.parquet(out)
    back = spark.read.parquet(out)
    sizes = back.groupBy("_path").agg(F.count(F.lit(1)).alias("n"))
    folder = F.regexp_extract("_path", "l_returnflag=([^/]+)/", 1)
    earlier = Window.partitionBy("l_returnflag").orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("l_returnflag", folder).withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return back.join(starts, "_path").select("l_returnflag", (F.col("start") + F.col("row")).alias("place"), "l_orderkey", "l_linenumber")


def q_filter_ticker_sets(spark, sf_dir):
    """Rows of ``lineitem`` by two sets that come from other tables: parts as values, suppliers as prefixes."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("L"), F.col("l_partkey").cast("string")).alias("ticker"))
    values = table(spark, sf_dir, "part").filter("p_size % 5 = 0").select(F.concat(F.lit("L"), F.col("p_partkey").cast("string")).alias("v"))
    prefixes = table(spark, sf_dir, "supplier").filter("s_suppkey % 4 = 1").select(F.concat(F.lit("L"), F.col("s_suppkey").cast("string"), F.lit("7")).alias("p"))
    return filter_by_sets(li, "ticker", values, prefixes)


# --------------------------------------------------------------------------- #
# Hints, JSON fallbacks, force and dry run, the preset
# --------------------------------------------------------------------------- #


def q_type_hints(spark, sf_dir):
    """Rows and type of the columns of exported ``orders`` that are empty in every row: known names have types, others are text."""
    orders = table(spark, sf_dir, "orders")
    empty = ["otc", "conditions", "correction", "remark"]
    rows = orders.select("o_orderkey", *(F.lit(None).cast("string").alias(c) for c in empty))
    path = scratch_path(spark, "hints")
    get_format("csv.gz").write(rows, path)
    groups, _, _ = infer_file_schemas(spark, _export_files(spark, path))
    (g,) = groups.values()
    back = scan_csv(spark, [r.path for r in _export_files(spark, path).collect()], g["schema"])
    kinds = {f.name: f.dataType.simpleString() for f in g["schema"].fields}
    seen = back.agg(*(F.count(c).alias(f"n_{c}") for c in empty), F.count(F.lit(1)).alias("rows"))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(f"n_{c}").alias("filled")) for c in empty)))
    # an empty field of a text column is an empty text, of any other a null
    return seen.select(each.alias("e"), "rows").select("e.column", "e.type", "e.filled", "rows")


def q_jsonl_fallbacks(spark, sf_dir):
    """Decimals and bytes of ``orders`` through JSON Lines: both come back as text."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(20,2)").alias("price"), F.encode("o_orderpriority", "UTF-8").alias("priority"),
    )
    path = scratch_path(spark, "jsonl-fallbacks")
    get_format("jsonl").write(rows, path)
    return read_output(spark, "jsonl", path).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "price", "priority")


def q_ingest_force_dry_run(spark, sf_dir):
    """Files per status and reason of a dry run, a run, a rerun, a dry run with force and a forced run."""
    ensure_utc(spark)
    rows = _event_rows(spark, sf_dir)
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    src, out = scratch_path(spark, "forced"), scratch_path(spark, "forced-out")
    export_daily_files(spark, rows, src, EVENT_ROW.names)
    steps = []
    for step, kw in enumerate([dict(dry_run=True), {}, {}, dict(dry_run=True, force=True), dict(force=True)]):
        run = ingest(spark, src, out, [SIBLINGS], start_date=first, end_date=last, path_template=SIBLING_TEMPLATE, **kw)
        day = K.date_from_key("key").alias("day")
        steps.append(run.result.select(F.lit(step).alias("step"), day, "status", "reason").distinct())
    done = steps[0]
    for more in steps[1:]:
        done = done.unionByName(more)
    return done.groupBy("step", "status", "reason").agg(F.count(F.lit(1)).alias("days"))


def q_ingest_underlying(spark, sf_dir):
    """Trades and quotes of one underlying out of option files made from ``events``."""
    ensure_utc(spark)
    ev = table(spark, sf_dir, "events")
    symbol = F.element_at(F.array(F.lit("ZED"), F.lit("KIT"), F.lit("ORB")), (F.col("event_id") % 3 + 1).cast("int"))
    rows = ev.select(
        F.when(F.col("event_id") % 2 == 0, "us_options_opra/trades_v1").otherwise("us_options_opra/quotes_v1").alias("dataset"),
        F.col("ts").cast("date").alias("file_date"), "event_id",
        F.concat(F.lit("O:"), symbol, F.date_format("ts", "yyMMdd"), F.lit("C"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("ticker"), "value",
    )
    src, out = scratch_path(spark, "options"), scratch_path(spark, "options-out")
    export_daily_files(spark, rows, src, EVENT_ROW.names)
    first, last = rows.agg(F.min("file_date"), F.max("file_date")).first()
    _checked(ingest_underlying(spark, src, out, "KIT", "both", start_date=first, end_date=last, path_template=SIBLING_TEMPLATE, column_types={"value": "float64"}))
    return present(spark.read.parquet(out).select("event_id", "ticker", "value", "data_type", F.col("file_date").cast("date")))


# --------------------------------------------------------------------------- #
# Flagship: newest 3 days per event type -> filter -> epoch/ISO -> counts
# --------------------------------------------------------------------------- #


def q_flagship(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cat = events_catalog(spark, sf_dir)
    latest = C.select_latest(cat, EVENT_DATASETS, 3, TODAY_EVENTS).select("key")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = ev.select(
        K.key_for_date(events_prefix(), F.col("ts").cast("date"), "csv.gz").alias("key"),
        "event_type",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        (us * 1000 + F.col("event_id") % 1000).alias("sip_timestamp"),
    )
    picked = rows.join(latest, "key", "left_semi")
    filtered = filter_tickers(picked, "ticker", ["U7"], ["U1"])
    conv = convert_epochs(filtered, resolve_timestamp_columns(filtered.schema, "auto"), "ns")
    # Aggregate numbers (hash aggregate) and render text afterwards; a min
    # over strings would force a sort-based aggregate.
    agg = conv.groupBy("key", "event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("sip_timestamp_ns").alias("_first_ns"),
        F.max("sip_timestamp").cast("timestamp_ntz").alias("last_ts"),
    )
    return agg.select("key", "event_type", "rows", iso_from_epoch_ns("_first_ns").alias("first_iso"), "last_ts")


QUERIES = {
    "filter_in_or_prefix": q_filter_in_or_prefix,
    "filter_in": q_filter_in,
    "filter_prefix": q_filter_prefix,
    "filter_cast_prefix": q_filter_cast_prefix,
    "filter_cast_double": q_filter_cast_double,
    "project": q_project,
    "row_filter": q_row_filter,
    "epoch_to_ts": q_epoch_to_ts,
    "epoch_auto": q_epoch_auto,
    "iso_timestamp": q_iso_timestamp,
    "extract_underlying": q_extract_underlying,
    "dataset_parts": q_dataset_parts,
    "key_for_date": q_key_for_date,
    "render_path": q_render_path,
    "iter_months": q_iter_months,
    "resolve_dataset": q_resolve_dataset,
    "datasets_without_files": q_datasets_without_files,
    "signature": q_signature,
    "catalog": q_catalog,
    "rows_per_file": q_rows_per_file,
    "date_range": q_date_range,
    "latest_one": q_latest_one,
    "latest_n": q_latest_n,
    "list_datasets": q_list_datasets,
    "list_dates": q_list_dates,
    "union_datasets": q_union_datasets,
    "union_schemas": q_union_schemas,
    "plan_incremental": q_plan_incremental,
    "plan_status_counts": q_plan_status_counts,
    "plan_new_files": q_plan_new_files,
    "manifest_current": q_manifest_current,
    "manifest_forget": q_manifest_forget,
    "empty_partitions": q_empty_partitions,
    "sink_parquet": q_sink_parquet,
    "sink_feather": q_sink_feather,
    "sink_csv": q_sink_csv,
    "sink_csv_gz": q_sink_csv_gz,
    "sink_jsonl": q_sink_jsonl,
    "sink_jsonl_gz": q_sink_jsonl_gz,
    "republish_overwrite": q_republish_overwrite,
    "scan_csv": q_scan_csv,
    "infer_schema": q_infer_schema,
    "type_override": q_type_override,
    "failed_files": q_failed_files,
    "sink_raw": q_sink_raw,
    "sink_raw_ranges": q_sink_raw_ranges,
    "listing": q_listing,
    "stream_available_now": q_stream_available_now,
    "stream_ingest_events": q_stream_ingest_events,
    "ingest_events": q_ingest_events,
    "ingest_lineitem": q_ingest_lineitem,
    "ingest_two_files_per_day": q_ingest_two_files_per_day,
    "ingest_schema_drift": q_ingest_schema_drift,
    "ingest_outcomes": q_ingest_outcomes,
    "ingest_status_counts": q_ingest_status_counts,
    "ingest_batch_then_stream": q_ingest_batch_then_stream,
    "quoted_lines": q_quoted_lines,
    "file_row_order": q_file_row_order,
    "filter_ticker_sets": q_filter_ticker_sets,
    "type_hints": q_type_hints,
    "jsonl_fallbacks": q_jsonl_fallbacks,
    "ingest_force_dry_run": q_ingest_force_dry_run,
    "ingest_underlying": q_ingest_underlying,
    "flagship": q_flagship,
}
