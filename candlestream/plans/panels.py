"""Chart and table panels: the newest rows per symbol of a candle or indicator table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestream.operators.latest import latest_n, only_symbols, top_rows
from candlestream.operators.totals import CARRIED, KNOWN, newest_dates, resumed
from candlestream.plans.strategies import Strategy
from candlestream.session import materialize

# Row limits of the panels and titles of their columns (fixed values).
CHART_ROWS, INDICATOR_ROWS, TABLE_ROWS = 500, 300, 15
BAND_TITLES = {
    "close": "Giá đóng cửa",
    "bb_upper": "BB Thượng (Upper)",
    "bb_middle": "BB Trung dung (Middle)",
    "bb_lower": "BB Hạ (Lower)",
}
SMA_RSI_TITLES = {
    "sma_9": "SMA 9 (Ngắn hạn)",
    "sma_21": "SMA 21 (Dài hạn)",
    "rsi_14": "Sức mạnh RSI-14",
}
SIGNAL_TITLES = {
    "event_time": "Thời gian (UTC)",
    "symbol": "Cặp tỷ giá",
    "close": "Giá đóng",
    "bb_signal": "Trạng thái Bollinger",
    "sma_crossover": "Giao cắt SMA",
    "advice": "Chiến lược khuyến nghị",
}

_CANDLE = ["open", "high", "low", "close"]
_CHART = [*_CANDLE, "volume", "vwap", "rsi", "advice"]


def newest_labels(
    candles: DataFrame, strategy: Strategy, n: int, totals: DataFrame | None = None
) -> DataFrame:
    """The strategy's newest n rows per symbol without computing the rest of the history.

    The newest n candles and as many before them as the indicators look back decide them. Running
    totals also need `totals`, the index of these candles (see `operators.totals`).
    """
    if strategy.totals:
        if totals is None:
            raise ValueError(f"{strategy.name} needs the whole history or an index of its totals")
        rows = resumed(candles, totals, newest_dates(totals, n), strategy.reach)
        rows, _ = materialize(rows, "newest")
        labelled = strategy.label(rows, CARRIED).filter(~F.col(KNOWN))
        return top_rows(labelled.select(*strategy.columns), n)
    labelled = strategy.label(top_rows(candles, n + strategy.reach, place="newness"))
    return labelled.filter(F.col("newness") <= n).select(*strategy.columns)


def _chart(
    df: DataFrame, time: str, columns: Sequence[str], n: int | None, symbols: Sequence[str] | None
) -> DataFrame:
    """`time` and `columns` of each symbol's newest n rows that have a time, oldest first. n is
    None for tables that hold the newest rows only, such as those of `newest_labels`."""
    rows = df.select("symbol", F.col(time).alias("time"), *columns).dropna(subset=["time"])
    if n is None:
        return only_symbols(rows, symbols).orderBy("symbol", "time")
    return latest_n(rows, n, "time", symbols=symbols)


def candle_chart(
    df: DataFrame, n: int = CHART_ROWS, symbols: Sequence[str] | None = None
) -> DataFrame:
    """By the time of the last trade."""
    return _chart(df, "event_time", [*_CANDLE, "rsi", "advice"], n, symbols)


def window_chart(
    df: DataFrame, n: int = CHART_ROWS, symbols: Sequence[str] | None = None
) -> DataFrame:
    """By window start; rows of writers that store none are left out."""
    return _chart(df, "window_start", _CHART, n, symbols)


def mixed_chart(
    df: DataFrame, n: int = CHART_ROWS, symbols: Sequence[str] | None = None
) -> DataFrame:
    """By window start, or by last trade where a writer stored no window."""
    timed = df.filter("window_start IS NOT NULL OR event_time IS NOT NULL").withColumn(
        "chart_time", F.coalesce("window_start", "event_time")
    )
    return _chart(timed, "chart_time", _CHART, n, symbols)


def _titled(titles: dict[str, str]) -> list:
    return [F.col(name).alias(title) for name, title in titles.items()]


def band_panel(
    df: DataFrame, n: int | None = INDICATOR_ROWS, symbols: Sequence[str] | None = None
) -> DataFrame:
    return _chart(df, "event_time", list(BAND_TITLES), n, symbols).select(
        "symbol", "time", *_titled(BAND_TITLES)
    )


def sma_rsi_panel(
    df: DataFrame, n: int | None = INDICATOR_ROWS, symbols: Sequence[str] | None = None
) -> DataFrame:
    return _chart(df, "event_time", list(SMA_RSI_TITLES), n, symbols).select(
        "symbol", "time", *_titled(SMA_RSI_TITLES)
    )


def signal_table(
    df: DataFrame, n: int | None = TABLE_ROWS, symbols: Sequence[str] | None = None
) -> DataFrame:
    """Newest first."""
    rows = df.select(*SIGNAL_TITLES).dropna(subset=["event_time"])
    if n is None:
        newest_first = only_symbols(rows, symbols).orderBy("symbol", F.col("event_time").desc())
        return newest_first.select(*_titled(SIGNAL_TITLES))
    return latest_n(rows, n, symbols=symbols, ascending=False).select(*_titled(SIGNAL_TITLES))


def newest(
    df: DataFrame, n: int = 5, time: str = "event_time", symbols: Sequence[str] | None = None
) -> DataFrame:
    """The n newest rows of the whole table."""
    return only_symbols(df, symbols).orderBy(F.col(time).desc()).limit(n)
