"""Registries and constants shared by the catalog, the reader and the sinks.

Everything here is plain dimension data.  Small lookups are turned into
DataFrames where they take part in joins (``alias_frame``/``asset_class_frame``);
the frames have a fixed, tiny size, so broadcasting them is always safe.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- #
# FIXED VALUES — these must equal the upstream tool's values for the same
# results (dataset aliases, epoch column names, empty-column hints, null and
# boolean tokens of the CSV type inference).  Keep them as plain text.
# --------------------------------------------------------------------------- #

#: Short names of the top-level asset-class prefixes in the bucket.
ASSET_CLASSES: dict[str, str] = {
    "stocks": "us_stocks_sip",
    "options": "us_options_opra",
    "indices": "us_indices",
    "forex": "global_forex",
    "crypto": "global_crypto",
}

#: Aliases for datasets known to be published.
KNOWN_DATASETS: dict[str, str] = {
    "stocks/trades": "us_stocks_sip/trades_v1",
    "stocks/quotes": "us_stocks_sip/quotes_v1",
    "stocks/minute_aggs": "us_stocks_sip/minute_aggs_v1",
    "stocks/day_aggs": "us_stocks_sip/day_aggs_v1",
    "options/trades": "us_options_opra/trades_v1",
    "options/quotes": "us_options_opra/quotes_v1",
    "options/minute_aggs": "us_options_opra/minute_aggs_v1",
    "options/day_aggs": "us_options_opra/day_aggs_v1",
    "indices/minute_aggs": "us_indices/minute_aggs_v1",
    "indices/day_aggs": "us_indices/day_aggs_v1",
    "forex/quotes": "global_forex/quotes_v1",
    "forex/minute_aggs": "global_forex/minute_aggs_v1",
    "forex/day_aggs": "global_forex/day_aggs_v1",
    "crypto/trades": "global_crypto/trades_v1",
    "crypto/quotes": "global_crypto/quotes_v1",
    "crypto/minute_aggs": "global_crypto/minute_aggs_v1",
    "crypto/day_aggs": "global_crypto/day_aggs_v1",
}

#: Integer epoch columns converted by ``timestamp_columns="auto"`` (plus any
#: column whose name ends in ``_timestamp``).
TIMESTAMP_COLUMN_NAMES: frozenset[str] = frozenset(
    {
        "sip_timestamp",
        "participant_timestamp",
        "trf_timestamp",
        "window_start",
        "window_end",
        "timestamp",
    }
)

#: Type used for a column that is empty in the whole sampled head.
COLUMN_TYPE_HINTS: dict[str, str] = {
    "otc": "bool",
    "correction": "int64",
    "tape": "int64",
    "trf_id": "int64",
    "trf_timestamp": "int64",
    "sequence_number": "int64",
    "sip_timestamp": "int64",
    "participant_timestamp": "int64",
    "window_start": "int64",
    "conditions": "string",
    "indicators": "string",
}

#: Cell texts read as NULL in non-string columns (CSV type inference).
NULL_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

#: Cell texts of a boolean column.
TRUE_TOKENS: tuple[str, ...] = ("1", "True", "TRUE", "true")
FALSE_TOKENS: tuple[str, ...] = ("0", "False", "FALSE", "false")

#: Spellings of "no compression" accepted for an output codec.
NO_COMPRESSION: frozenset = frozenset({None, "", "none", "None", "NONE", "uncompressed"})

#: Compression suffixes of source files (matched case-insensitively).
COMPRESSION_SUFFIXES: dict[str, str] = {
    ".gz": "gzip",
    ".gzip": "gzip",
    ".zst": "zstd",
    ".bz2": "bz2",
    ".lz4": "lz4",
}

#: Default look-back of newest-N selection, in calendar months.
LATEST_MAX_MONTHS = 24

#: Bytes of decompressed head sampled per file for schema inference.
DEFAULT_PEEK_BYTES = 16 * 1024 * 1024

#: Default output layout template and its placeholders.
DEFAULT_PATH_TEMPLATE = "{dataset}/{year}/{month}/{date}.{ext}"
TEMPLATE_PLACEHOLDERS: tuple[str, ...] = (
    "dataset", "asset_class", "data_type", "name", "year",
    "month", "day", "date", "ext", "filename",
)

# --------------------------------------------------------------------------- #
# End of fixed values.
# --------------------------------------------------------------------------- #


def alias_frame(spark):
    """``(alias, prefix)`` rows of :data:`KNOWN_DATASETS` (17 rows)."""
    return spark.createDataFrame(sorted(KNOWN_DATASETS.items()), "alias string, prefix string")


def asset_class_frame(spark):
    """``(asset_alias, asset_prefix)`` rows of :data:`ASSET_CLASSES` (5 rows)."""
    return spark.createDataFrame(
        sorted(ASSET_CLASSES.items()), "asset_alias string, asset_prefix string"
    )
