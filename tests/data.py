"""Small literal inputs and a plain-Python model of the rolling indicators."""

from __future__ import annotations

import datetime as dt
import random
import statistics

from candlestream.schemas import candle_schema

START = dt.datetime(2024, 1, 1)


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def trades(spark, rows, tie=False):
    """rows: (symbol, seconds, price, quantity[, tie])"""
    columns = "symbol string, event_time timestamp, price double, quantity double"
    return spark.createDataFrame(
        [(r[0], at(r[1]), *r[2:]) for r in rows], columns + (", id long" if tie else "")
    )


def candles(spark, rows):
    """rows: (symbol, minute, close[, volume])"""
    full = []
    for symbol, minute, close, *volume in rows:
        start = at(60 * minute)
        v = float(volume[0]) if volume else 1.0
        full.append((
            symbol, close, close, close, close, v, close, close,
            start + dt.timedelta(seconds=59), start, start + dt.timedelta(seconds=60),
        ))
    return spark.createDataFrame(full, candle_schema())


def closes(spark, values, volumes=None):
    volumes = volumes or [1.0] * len(values)
    return candles(spark, [("A", i, float(c), v) for i, (c, v) in enumerate(zip(values, volumes))])


def walk(seed: int, symbols: dict[str, int], gap: int = 1) -> list[tuple]:
    """Random walks of whole cents; `gap` > 1 leaves minutes without a candle."""
    rng = random.Random(seed)
    rows = []
    for symbol, n in symbols.items():
        cents, minute = 1_000_000, 0
        for _ in range(n):
            cents += rng.randint(-500, 500)
            minute += rng.randint(1, gap)
            rows.append((symbol, minute, cents / 100, rng.randint(0, 50)))
    rng.shuffle(rows)
    return rows


def column(df, name, order="event_time"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def model(closes, volumes):
    """Unrounded indicators of one symbol, by the definitions, one row at a time."""
    out, obv = [], 0.0
    gains, losses, macd = [], [], []
    mean = statistics.fmean
    for i, c in enumerate(closes):
        d = c - closes[i - 1] if i else 0.0
        gains.append(max(d, 0.0))
        losses.append(max(-d, 0.0))
        obv += volumes[i] if d > 0 else -volumes[i] if d < 0 else 0.0
        g, l = mean(gains[-14:]), mean(losses[-14:])
        macd.append(mean(closes[max(0, i - 11):i + 1]) - mean(closes[max(0, i - 25):i + 1]))
        last20 = closes[max(0, i - 19):i + 1]
        past = volumes[max(0, i - 20):i]
        full = i >= 19
        out.append({
            "rsi_14": None if i < 13 else 100.0 if l == 0 else 100 - 100 / (1 + g / l),
            "histogram": macd[-1] - mean(macd[-9:]),
            "spike": int(bool(past) and volumes[i] > 1.5 * mean(past)),
            "bb_upper": mean(last20) + 2 * statistics.stdev(last20) if full else None,
            "sma_9": mean(closes[i - 8:i + 1]) if i >= 8 else None,
            "sma_21": mean(closes[i - 20:i + 1]) if i >= 20 else None,
            "obv": obv,
        })
    return out
