"""Command-line entry for spark-submit: pull, list-datasets, list-dates, list-formats.

    spark-submit scripts/flatlake_cli.py pull -s s3a://bucket -o s3a://lake \\
        -d stocks/day_aggs --last 3 -f parquet

Arguments are parsed here; all work runs in the library's Spark jobs.  The
exit code is 1 when any file failed.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from flatlake.ingest import ingest  # noqa: E402
from flatlake.session import get_spark  # noqa: E402
from flatlake.sinks.formats import list_formats  # noqa: E402
from flatlake.sources import catalog as C  # noqa: E402
from flatlake.sources.listing import list_prefixes, listing  # noqa: E402
from flatlake.sources.schema import parse_column_types  # noqa: E402


def _date(text: str) -> date:
    return date.fromisoformat(text)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="flatlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    pull = sub.add_parser("pull", help="ingest dated flat files")
    pull.add_argument("-s", "--source", required=True, help="bucket root (any Hadoop path)")
    pull.add_argument("-o", "--output-dir", required=True)
    pull.add_argument("-d", "--dataset", action="append", required=True)
    pull.add_argument("-f", "--format", default="parquet")
    pull.add_argument("--compression", default="default")
    pull.add_argument("--start-date", type=_date)
    pull.add_argument("--end-date", type=_date)
    pull.add_argument("--latest", action="store_true", help="the newest file of each dataset")
    pull.add_argument("--last", type=int, help="the newest N files of each dataset")
    pull.add_argument("--ticker", action="append", default=[])
    pull.add_argument("--ticker-prefix", action="append", default=[])
    pull.add_argument("--filter-column", default="ticker")
    pull.add_argument("--columns", help="comma-separated columns to keep")
    pull.add_argument("--column-type", action="append", default=[], help="NAME=TYPE, repeatable")
    pull.add_argument("--timestamp-columns", default="auto")
    pull.add_argument("--timestamp-unit", default="ns", choices=["s", "ms", "us", "ns"])
    pull.add_argument("--path-template", default=None)
    pull.add_argument("--force", action="store_true")
    pull.add_argument("--dry-run", action="store_true")

    ds = sub.add_parser("list-datasets", help="every asset_class/data_type prefix")
    ds.add_argument("-s", "--source", required=True)

    dates = sub.add_parser("list-dates", help="files of one dataset")
    dates.add_argument("-s", "--source", required=True)
    dates.add_argument("-d", "--dataset", required=True)
    dates.add_argument("--year", type=int)
    dates.add_argument("--month", type=int)
    dates.add_argument("--last", type=int)

    sub.add_parser("list-formats", help="registered output formats")
    return p


def main(argv=None) -> int:
    args = build_parser().parse_args(argv)
    spark = get_spark()
    if args.cmd == "list-formats":
        for r in list_formats(spark).collect():
            print(f"{r.name}\t.{r.extension}\t{r.default_compression or 'none'}" if r.extension else f"{r.name}\t(source)\t-")
        return 0
    if args.cmd == "list-datasets":
        frame = C.datasets_frame(spark, list_prefixes(listing(spark, args.source)))
        for r in frame.orderBy("prefix").collect():
            print(r.prefix + (f"\t({r.alias})" if r.alias else ""))
        return 0
    if args.cmd == "list-dates":
        prefix = C.resolve_dataset(args.dataset)
        cat = C.build_catalog(listing(spark, args.source, [prefix]))
        for r in C.list_dates(cat, prefix, args.year, args.month, args.last).collect():
            print(r.key)
        return 0

    if args.latest and args.last:
        raise SystemExit("use --latest or --last, not both")
    latest = 1 if args.latest else args.last
    kwargs = {}
    if args.path_template:
        kwargs["path_template"] = args.path_template
    run = ingest(
        spark, args.source, args.output_dir, args.dataset,
        start_date=args.start_date, end_date=args.end_date, latest=latest,
        output_format=args.format, compression=args.compression,
        tickers=args.ticker, ticker_prefixes=args.ticker_prefix, filter_column=args.filter_column,
        columns=[c.strip() for c in args.columns.split(",") if c.strip()] if args.columns else None,
        column_types=parse_column_types(args.column_type),
        timestamp_columns=args.timestamp_columns, timestamp_unit=args.timestamp_unit,
        force=args.force, dry_run=args.dry_run, **kwargs,
    )
    counts = {r.status: r["files"] for r in run.result.groupBy("status").agg(F.count(F.lit(1)).alias("files")).collect()}
    print(", ".join(f"{k}: {v}" for k, v in sorted(counts.items())) or "nothing selected")
    for r in run.result.filter(F.col("status") == "failed").collect():
        print(f"FAILED {r.key}: {r.error}", file=sys.stderr)
    return 1 if counts.get("failed") else 0


if __name__ == "__main__":
    sys.exit(main())
