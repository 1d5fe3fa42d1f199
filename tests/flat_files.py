"""Small invented market days as flat files in the bucket's key layout, written with pandas."""

from __future__ import annotations

import gzip
import pathlib
from datetime import date

import pandas as pd

#: Contract -> quotes on a day.  Seven quotes, five of them of the underlying ZED.
CONTRACTS = {"O:ZED251219C00042000": 4, "O:ZED251219P00042000": 1, "O:KIT260116C00007500": 2}
SYMBOLS = ("KIT", "ORB", "ZED")
OPENED = int(pd.Timestamp("2024-11-05T14:30:00Z").value)
QUOTES, BARS = "us_options_opra/quotes_v1", "us_stocks_sip/day_aggs_v1"
QUOTE_DAYS = (date(2024, 11, 5), date(2024, 11, 29), date(2024, 12, 2))
BAR_DAYS = (date(2024, 11, 29), date(2024, 12, 2), date(2025, 1, 15), date(2025, 2, 3))
#: The day on which the tests look back.
TODAY = date(2025, 2, 10)


def key_of(dataset: str, day: date, more: str = "", suffix: str = ".csv.gz") -> str:
    return f"{dataset}/{day:%Y/%m/%Y-%m-%d}{more}{suffix}"


def packed(frame: pd.DataFrame, zipped: bool = True) -> bytes:
    text = frame.to_csv(index=False).encode()
    return gzip.compress(text, mtime=0) if zipped else text


def quote_day(contracts: dict[str, int] = CONTRACTS) -> pd.DataFrame:
    """One quote a millisecond, contract after contract; asks widen with every quote of a contract."""
    frame = pd.DataFrame([(c, n) for c, many in contracts.items() for n in range(many)], columns=["ticker", "n"])
    return pd.DataFrame({
        "ticker": frame["ticker"],
        "ask_price": 3.25 + frame["n"] / 8,
        "bid_price": 3.0 - frame["n"] / 8,
        "sip_timestamp": OPENED + frame.index.to_numpy() * 1_000_001,
    })


def bar_day(symbols=SYMBOLS) -> pd.DataFrame:
    """One bar a symbol: closes of 20.5, 21.5, ...; volumes of 700, 1400, ...; the column otc is empty."""
    n = range(len(symbols))
    return pd.DataFrame({
        "ticker": symbols, "volume": [700 * (i + 1) for i in n], "open": [20.0 + i for i in n], "close": [20.5 + i for i in n],
        "high": [22.0 + i for i in n], "low": [19.0 + i for i in n], "window_start": [OPENED + i for i in n], "otc": None,
    })


def put(root, key: str, content: bytes) -> None:
    target = pathlib.Path(root) / key
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content)


def put_all(root, contents: dict[str, bytes]) -> None:
    for key, content in contents.items():
        put(root, key, content)


def market(root) -> str:
    """Three days of quotes and four of bars under *root*."""
    for day in QUOTE_DAYS:
        put(root, key_of(QUOTES, day), packed(quote_day()))
    for day in BAR_DAYS:
        put(root, key_of(BARS, day), packed(bar_day()))
    return str(root)
