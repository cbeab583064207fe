"""Symbol lists: normalisation, validation, set differences."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PATTERN = r"^[A-Z0-9]{5,24}$"
_QUOTE = "USDT"
# The symbols that are watched where none are configured.
DEFAULT_SYMBOLS = (
    "BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT", "DOGEUSDT", "SUIUSDT", "ADAUSDT", "LINKUSDT", "AVAXUSDT", "WIFUSDT", "1000PEPEUSDT", "APTUSDT",
    "ARBUSDT", "SEIUSDT", "ATOMUSDT", "NEARUSDT", "INJUSDT", "FILUSDT", "TIAUSDT", "OPUSDT", "RENDERUSDT", "FETUSDT", "TRXUSDT", "LTCUSDT",
)


def normalize_symbols(symbols: list[str]) -> list[str]:
    """Trimmed, upper-cased, distinct in order; an error for none or an invalid one."""
    out: dict[str, None] = {}
    for s in (x.strip().upper() for x in symbols):
        if s:
            if not re.match(_PATTERN, s) or not s.endswith(_QUOTE):
                raise ValueError(f"invalid symbol: {s}")
            out[s] = None
    if not out:
        raise ValueError("no symbols")
    return list(out)


def parse_symbols(text: str | None) -> list[str]:
    """The symbols of a comma-separated list; the default ones if there is no list."""
    return list(DEFAULT_SYMBOLS) if text is None else normalize_symbols(text.split(","))


def ordered_distinct(df: DataFrame, name: str, pos: str) -> DataFrame:
    """(symbol, pos): each normalised name at its first position; blanks go."""
    clean = df.select(F.upper(F.trim(name)).alias("symbol"), F.col(pos).alias("pos")).where("symbol <> ''")
    return clean.groupBy("symbol").agg(F.min("pos").alias("pos"))


def is_valid(col: str):
    return F.col(col).rlike(_PATTERN) & F.col(col).endswith(_QUOTE)


def invalid_symbols(configured: DataFrame, active: DataFrame, by: str = "symbol") -> DataFrame:
    """Configured names that are not active."""
    return configured.select(by).distinct().join(active.select(by), by, "left_anti")
