"""Ticker expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Option ticker: ``O:<underlying><YYMMDD><C|P><strike*1000, 8 digits>``.
OPTION_TICKER_PATTERN = r"^O:([A-Z]+)[0-9]{6}[CP][0-9]{8}$"


def extract_underlying(ticker) -> Column:
    """Underlying symbol of an option ticker.

    Strict pattern first; otherwise drop a leading ``O:`` and keep the leading
    letters; otherwise ``UNKNOWN``.  NULL stays NULL.
    """
    t = F.col(ticker) if isinstance(ticker, str) else ticker
    strict = F.nullif(F.regexp_extract(t, OPTION_TICKER_PATTERN, 1), F.lit(""))
    stripped = F.regexp_replace(t, r"^O:", "")
    letters = F.nullif(F.regexp_extract(stripped, r"^(\p{L}+)", 1), F.lit(""))
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(strict, letters, F.lit("UNKNOWN"))
    )
