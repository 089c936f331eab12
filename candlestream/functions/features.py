"""Row-wise candle features: no shuffle, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where `whole` is 0 or NULL (a bare division by 0 raises)."""
    return F.when(whole != 0, part / whole).otherwise(0.0)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole * 100).otherwise(0.0)


def candle_features(c: DataFrame) -> DataFrame:
    """Change, volatility, trend and body/range of each candle."""
    opened, closed = F.col("open"), F.col("close")
    move, spread = closed - opened, F.col("high") - F.col("low")
    return c.withColumns({
        "price_change": move,
        "price_change_pct": percent(move, opened),
        "volatility": percent(spread, opened),
        "trend": F.when(move > 0, "UP").when(move < 0, "DOWN").otherwise("SIDEWAYS"),
        "body_size": F.abs(move),
        "range_size": spread,
        "candle_strength": share(F.abs(move), spread),
    })


def risk_level(c: DataFrame, medium: float = 1, high: float = 2) -> DataFrame:
    """HIGH / MEDIUM / LOW by volatility in percent; both bounds belong to the higher class."""
    level = F.col("volatility")
    return c.withColumn(
        "risk_level", F.when(level >= high, "HIGH").when(level >= medium, "MEDIUM").otherwise("LOW")
    )


def single_candle_rsi(c: DataFrame, eps: float = 0.001) -> DataFrame:
    """RSI of one candle's own move; `eps` stands in for the side that did not move."""
    move = F.col("close") - F.col("open")
    up = F.when(move > 0, move).otherwise(eps)
    down = F.when(move < 0, -move).otherwise(eps)
    return c.withColumn("rsi", 100 - 100 / (1 + up / down))
