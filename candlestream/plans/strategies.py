"""A strategy: candle width, indicators, rules and result columns under one name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType

from candlestream.functions.features import candle_features, risk_level, single_candle_rsi
from candlestream.functions.rules import RuleList, advise
from candlestream.operators import indicators as ind
from candlestream.operators.latest import complete
from candlestream.plans import signals
from candlestream.schemas import candle_schema

_OHLC = ["symbol", "open", "high", "low", "close"]
_PRICES = [*_OHLC, "volume", "avg_price", "vwap"]
_FEATURES = [
    *_PRICES, "price_change", "price_change_pct", "volatility", "trend", "candle_strength",
]
_WINDOW = ["event_time", "window_start", "window_end"]


@dataclass(frozen=True)
class Strategy:
    """`prepare` completes the candles; `indicators` are added to them, then the rules judge.

    Strategies with indicators look back over a symbol's earlier candles; the others judge every
    candle alone and need no shuffle beyond the one that made the candles. Result columns, their
    order, and the widths and delays of 10 and 60 seconds are fixed values.
    """

    name: str
    prepare: Callable[[DataFrame], DataFrame]
    rules: RuleList
    columns: tuple[str, ...]
    width: str = "10 seconds"
    watermark: str = "10 seconds"
    trigger: str = "10 seconds"
    indicators: tuple[ind.Indicator, ...] = ()
    # Whether candles without a symbol, close or time are left out.
    complete_only: bool = False

    @property
    def rolling(self) -> bool:
        return bool(self.indicators)

    @property
    def totals(self) -> bool:
        """Whether some value depends on the whole history."""
        return any(i.total_of for i in self.indicators)

    @property
    def reach(self) -> int:
        """How many earlier candles a row's values depend on, totals apart."""
        return max((i.reach for i in self.indicators), default=0)

    def label(self, candles: DataFrame, carried: str | None = None) -> DataFrame:
        """Candles with indicators and advice; helper columns included. `carried` is the column
        that running totals go on from."""
        indicators = [
            replace(i, carried=carried) if carried and i.total_of else i for i in self.indicators
        ]
        prepared = self.prepare(complete(candles) if self.complete_only else candles)
        if indicators:
            prepared = ind.add_indicators(prepared, *indicators)
        return advise(prepared, self.rules)

    def schema(self, spark: SparkSession, time_type: DataType | None = None) -> StructType:
        """The schema of the result table."""
        candles = spark.createDataFrame([], candle_schema(time_type))
        return self.label(candles).select(*self.columns).schema


def _vwap(c: DataFrame) -> DataFrame:
    return risk_level(single_candle_rsi(candle_features(c)))


BASIC = Strategy(
    "basic", single_candle_rsi, signals.BASIC, (*_OHLC, "event_time", "rsi", "advice"),
)
VWAP = Strategy(
    "vwap", _vwap, signals.VWAP, (*_FEATURES, "rsi", "risk_level", "advice", *_WINDOW),
)
MULTI = Strategy(
    "multi", lambda c: risk_level(candle_features(c)), signals.MULTI,
    (*_FEATURES, "RSI", "risk_level", "MACD_Histogram", "Volume_Spike", "BB_Upper", "BB_Lower",
     "OBV", "advice", "event_time"),
    width="60 seconds", watermark="60 seconds", trigger="60 seconds",
    indicators=(
        ind.Rsi(warmup=False, digits=3), ind.MacdSma(), ind.VolumeSpike(),
        ind.Bollinger(warmup=False, digits=3), ind.Obv(),
    ),
)
RSI14 = Strategy(
    "rsi14", lambda c: c, signals.RSI14, (*_PRICES, "event_time", "rsi_14", "advice"),
    indicators=(ind.Rsi(),), complete_only=True,
)
CROSS = Strategy(
    "cross", candle_features, signals.CROSS,
    (*_FEATURES, *_WINDOW, "bb_middle", "bb_upper", "bb_lower", "bb_signal", "sma_9", "sma_21",
     "sma_crossover", "rsi_14", "advice"),
    indicators=(ind.Bollinger(), ind.SmaCross(), ind.Rsi()), complete_only=True,
)

STRATEGIES = {s.name: s for s in (BASIC, VWAP, MULTI, RSI14, CROSS)}
