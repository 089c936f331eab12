"""Rolling indicators over candles, per symbol in time order.

An indicator is a small value such as `Rsi(n=14)` that says in *stages* which columns to add;
a stage may use the columns of the stages before it. `add_indicators(c, Rsi(), SmaCross(), ...)`
adds the first stages of all of them together, then the second ones: every stage of window
functions becomes one pass over the sorted candles, however many indicators there are, and the
whole chain costs one shuffle and one sort.

`digits` rounds every step half-up, which is part of the rounded indicator family's definition;
`warmup` makes a value NULL until its frame is full. Helper columns begin with "_" and are
dropped at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlestream.operators.history import BLOCK, HALO, partition_keys, with_earlier_totals

BY: tuple[str, ...] = ("symbol",)
TIME = "event_time"
# Volumes, and their sums, in on-balance volume.
EXACT, EXACT_TOTAL = "decimal(28,10)", "decimal(38,10)"
Stages = list[dict[str, Column]]


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


@dataclass(frozen=True)
class Frames:
    """The window frames of one candle table."""

    order: WindowSpec
    split: bool

    @staticmethod
    def of(c: DataFrame, by: Sequence[str], time: str) -> Frames:
        order = Window.partitionBy(*partition_keys(c, by)).orderBy(time)
        return Frames(order, BLOCK in c.columns)

    def last(self, n: int) -> WindowSpec:
        """The current row and the n - 1 before it."""
        return self.order.rowsBetween(1 - n, Window.currentRow)

    def past(self, n: int) -> WindowSpec:
        """The n rows before the current one."""
        return self.order.rowsBetween(-n, -1)

    def until(self, offset: int) -> WindowSpec:
        """All rows up to `offset` from the current one."""
        return self.order.rowsBetween(Window.unboundedPreceding, offset)

    def previous(self, value: str | Column) -> Column:
        return F.lag(value).over(self.order)

    def mean(self, column: str, n: int, warmup: bool = False) -> Column:
        mean = F.avg(column).over(self.last(n))
        return F.when(F.count(column).over(self.last(n)) >= n, mean) if warmup else mean


class Indicator:
    """Base of the indicators: the stages, and the first-stage column that is summed over all
    of the history. In a split history the second stage sums it within a block only, and the
    third finds its sum over all earlier blocks in `<column>_before`."""

    total_of: str | None = None

    @property
    def reach(self) -> int:
        """How many earlier rows a row's values depend on, running totals apart."""
        raise NotImplementedError

    def stages(self, at: Frames) -> Stages:
        raise NotImplementedError


def add_indicators(
    c: DataFrame, *indicators: Indicator, by: Sequence[str] = BY, time: str = TIME
) -> DataFrame:
    """Candles with the columns of all `indicators`."""
    at = Frames.of(c, by, time)
    totals = [i.total_of for i in indicators if i.total_of]
    stages = zip_longest(*(i.stages(at) for i in indicators), fillvalue={})
    for number, stage in enumerate(stages):
        c = c.withColumns({name: value for part in stage for name, value in part.items()})
        if number == 1 and at.split and totals:
            c = with_earlier_totals(c, totals)
    return c.drop(*[name for name in c.columns if name.startswith("_")])


@dataclass(frozen=True)
class CloseChange(Indicator):
    """Previous close, change, and the change split into gain and loss (0 on the first row)."""

    digits: int | None = None

    @property
    def reach(self) -> int:
        return 1

    def stages(self, at: Frames) -> Stages:
        change = F.col("change")
        return [
            {"prev_close": at.previous("close")},
            {"change": _rounded(F.col("close") - F.col("prev_close"), self.digits)},
            {
                "gain": F.when(change > 0, change).otherwise(0.0),
                "loss": F.when(change < 0, -change).otherwise(0.0),
            },
        ]


@dataclass(frozen=True)
class Rsi(Indicator):
    """Relative strength from plain means of gain and loss; 100 when nothing was lost."""

    n: int = 14
    warmup: bool = True
    digits: int | None = None
    name: str | None = None

    @property
    def reach(self) -> int:
        return self.n

    def stages(self, at: Frames) -> Stages:
        name = self.name or (f"rsi_{self.n}" if self.warmup else "RSI")
        change, gain, loss = F.col("_change"), F.col("_mean_gain"), F.col("_mean_loss")

        def mean(side: Column) -> Column:
            return _rounded(F.avg(side).over(at.last(self.n)), self.digits)

        index = F.when(loss == 0, 100.0).otherwise(
            _rounded(100 - 100 / (1 + gain / loss), self.digits)
        )
        return [
            {"_change": _rounded(F.col("close") - at.previous("close"), self.digits)},
            {
                "_mean_gain": mean(F.when(change > 0, change).otherwise(0.0)),
                "_mean_loss": mean(F.when(change < 0, -change).otherwise(0.0)),
                "_closes": F.count("close").over(at.last(self.n)),
            },
            {name: F.when(F.col("_closes") >= self.n, index) if self.warmup else index},
        ]


@dataclass(frozen=True)
class MacdSma(Indicator):
    """Histogram of a MACD built on simple means. `lines` keeps the two lines it is made of."""

    fast: int = 12
    slow: int = 26
    signal: int = 9
    digits: int | None = 3
    lines: bool = False

    @property
    def reach(self) -> int:
        return max(self.fast, self.slow) + self.signal - 2

    def stages(self, at: Frames) -> Stages:
        line, signal = ("macd_line", "signal_line") if self.lines else ("_macd", "_signal")
        return [
            {line: at.mean("close", self.fast) - at.mean("close", self.slow)},
            {signal: at.mean(line, self.signal)},
            {"MACD_Histogram": _rounded(F.col(line) - F.col(signal), self.digits)},
        ]


@dataclass(frozen=True)
class VolumeSpike(Indicator):
    """1 where volume exceeds `factor` times the mean of the n candles before, else 0.
    `mean` keeps that mean."""

    n: int = 20
    factor: float = 1.5
    mean: bool = False

    @property
    def reach(self) -> int:
        return self.n

    def stages(self, at: Frames) -> Stages:
        past = "past_volume" if self.mean else "_past_volume"
        above = F.col("volume") > F.col(past) * self.factor
        return [
            {past: F.avg("volume").over(at.past(self.n))},
            {"Volume_Spike": F.coalesce(above.cast("int"), F.lit(0))},
        ]


@dataclass(frozen=True)
class Bollinger(Indicator):
    """Mean plus and minus k sample deviations.

    With `warmup`: `bb_middle`, `bb_upper`, `bb_lower` and the position label `bb_signal`.
    Without: the rounded pair `BB_Upper`, `BB_Lower` from the first row on.
    """

    n: int = 20
    k: float = 2
    warmup: bool = True
    digits: int | None = None

    @property
    def reach(self) -> int:
        return self.n - 1

    def stages(self, at: Frames) -> Stages:
        middle, reach = F.col("_mid"), F.col("_dev") * self.k
        stats = {
            "_mid": at.mean("close", self.n, self.warmup),
            "_dev": F.stddev_samp("close").over(at.last(self.n)),
        }
        upper = _rounded(middle + reach, self.digits)
        lower = _rounded(middle - reach, self.digits)
        if not self.warmup:
            return [stats, {"BB_Upper": upper, "BB_Lower": lower}]
        bands = {
            "bb_middle": _rounded(middle, self.digits), "bb_upper": upper, "bb_lower": lower,
        }
        close = F.col("close")
        position = (
            F.when(F.col("bb_upper").isNull(), "NOT ENOUGH DATA")
            .when(close > F.col("bb_upper"), "ABOVE UPPER BAND")
            .when(close < F.col("bb_lower"), "BELOW LOWER BAND").otherwise("INSIDE BAND")
        )
        return [stats, bands, {"bb_signal": position}]


@dataclass(frozen=True)
class Obv(Indicator):
    """On-balance volume `OBV`, the previous row's `OBV_prv`, and the exact `obv_total`.

    Volumes are summed as decimals with ten places, so the total is the same however the history
    is cut, and rounded at the end; a total beyond 28 digits is an error, never a wrong value.

    `carried` names a column that replaces a candle's own signed volume where it is not NULL:
    the stored total on the last known candle and 0 on those before it lets a run go on from
    there.
    """

    carried: str | None = None
    digits: int | None = 3
    total_of = "_signed"

    @property
    def reach(self) -> int:
        return 1

    def stages(self, at: Frames) -> Stages:
        none = F.lit(0).cast(EXACT)
        step, volume = F.col("close") - at.previous("close"), F.col("volume").cast(EXACT)
        signed = F.when(step > 0, volume).when(step < 0, -volume).otherwise(none)
        if self.carried is not None:
            signed = F.coalesce(F.col(self.carried).cast(EXACT_TOTAL), signed)
        if at.split:
            signed = F.when(F.col(HALO), none).otherwise(signed)
        before = F.col("_signed_before") if at.split else none
        total = (F.col("_total") + before).cast(EXACT_TOTAL)
        previous = F.col("_previous") + before
        return [
            {"_signed": signed},
            {
                "_total": F.sum("_signed").over(at.until(0)),
                "_previous": F.sum("_signed").over(at.until(-1)),
            },
            {
                "obv_total": total,
                "OBV": _rounded(total, self.digits).cast("double"),
                "OBV_prv": _rounded(previous, self.digits).cast("double"),
            },
        ]


@dataclass(frozen=True)
class SmaCross(Indicator):
    """Short and long means with warm-up, and the label of their crossing.

    `digits` rounds the gap before its sign is taken, for prices whose means differ by float
    noise only.
    """

    short: int = 9
    long: int = 21
    digits: int | None = None

    @property
    def reach(self) -> int:
        return max(self.short, self.long)

    def stages(self, at: Frames) -> Stages:
        near, far = f"sma_{self.short}", f"sma_{self.long}"
        gap = _rounded(F.col(near) - F.col(far), self.digits)
        now, before = F.col("_gap"), F.col("_prev_gap")
        label = (
            F.when(now.isNull(), "NOT ENOUGH DATA")
            .when((before <= 0) & (now > 0), "GOLDEN CROSS")
            .when((before >= 0) & (now < 0), "DEATH CROSS")
            .when(now > 0, f"SMA{self.short} ABOVE SMA{self.long}")
            .when(now < 0, f"SMA{self.short} BELOW SMA{self.long}").otherwise("NO CROSS")
        )
        means = {
            near: at.mean("close", self.short, warmup=True),
            far: at.mean("close", self.long, warmup=True),
        }
        return [means, {"_gap": gap, "_prev_gap": at.previous(gap)}, {"sma_crossover": label}]


# Each indicator as a function from candles to candles.

def close_change(c: DataFrame, digits: int | None = None, **keys) -> DataFrame:
    return add_indicators(c, CloseChange(digits), **keys)


def rsi(
    c: DataFrame, n: int = 14, warmup: bool = True, digits: int | None = None,
    name: str | None = None, **keys,
) -> DataFrame:
    return add_indicators(c, Rsi(n, warmup, digits, name), **keys)


def macd_sma(
    c: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, digits: int | None = 3,
    lines: bool = False, **keys,
) -> DataFrame:
    return add_indicators(c, MacdSma(fast, slow, signal, digits, lines), **keys)


def volume_spike(
    c: DataFrame, n: int = 20, factor: float = 1.5, mean: bool = False, **keys
) -> DataFrame:
    return add_indicators(c, VolumeSpike(n, factor, mean), **keys)


def bollinger(
    c: DataFrame, n: int = 20, k: float = 2, warmup: bool = True, digits: int | None = None,
    **keys,
) -> DataFrame:
    return add_indicators(c, Bollinger(n, k, warmup, digits), **keys)


def obv(
    c: DataFrame, carried: str | None = None, digits: int | None = 3, **keys
) -> DataFrame:
    return add_indicators(c, Obv(carried, digits), **keys)


def sma_cross(
    c: DataFrame, short: int = 9, long: int = 21, digits: int | None = None, **keys
) -> DataFrame:
    return add_indicators(c, SmaCross(short, long, digits), **keys)
