"""The five advice rule lists.

Labels, thresholds and rule order are fixed values of the strategies. Some rules can never fire
(a single-candle RSI of at most 30 implies a falling candle, and a 5 % rise implies HIGH risk);
they stay, so that each list equals its definition.
"""

from candlestream.functions.rules import RuleList

BASIC = RuleList(
    rules=(
        ("rsi >= 70", "STRONG SELL (Overbought)"),
        ("rsi <= 30", "STRONG BUY (Oversold)"),
    ),
    default="HOLD (Neutral)",
)

VWAP = RuleList(
    rules=(
        ("rsi <= 30 AND trend = 'UP' AND risk_level <> 'HIGH'",
         "STRONG BUY (Oversold + Uptrend)"),
        ("rsi <= 30 AND risk_level = 'HIGH'", "WATCH BUY - HIGH RISK"),
        ("rsi >= 70 AND trend = 'DOWN'", "STRONG SELL (Overbought + Downtrend)"),
        ("rsi >= 70", "SELL WARNING (Overbought)"),
        ("volatility >= 2", "HOLD - HIGH VOLATILITY"),
        ("close > vwap AND trend = 'UP'", "BUY SIGNAL (Above VWAP)"),
        ("close < vwap AND trend = 'DOWN'", "SELL SIGNAL (Below VWAP)"),
    ),
    default="HOLD (Neutral)",
)

MULTI = RuleList(
    rules=(
        ("risk_level = 'HIGH'", "EXTREME RISK - AVOID TRADING"),
        ("price_change_pct > 5 AND close > BB_Upper AND OBV < 0 AND Volume_Spike = 0",
         "POTENTIAL BULL TRAP - CAUTION ADVISED"),
        ("close <= BB_Lower AND RSI < 30 AND Volume_Spike = 1 AND OBV > OBV_prv"
         " AND MACD_Histogram > 0 AND candle_strength > 0.7",
         "STRONG BUY SIGNAL - POTENTIAL REVERSAL FROM THE BOTTOM"),
        ("close >= BB_Upper AND RSI > 70 AND Volume_Spike = 1 AND OBV < OBV_prv"
         " AND MACD_Histogram < 0 AND candle_strength > 0.7",
         "STRONG SELL SIGNAL - POTENTIAL REVERSAL FROM THE TOP"),
        ("trend = 'UP' AND close > vwap AND close <= BB_Upper AND OBV > OBV_prv"
         " AND MACD_Histogram > 0 AND RSI BETWEEN 40 AND 65"
         " AND risk_level <> 'HIGH' AND volatility < 2",
         "BUY TREND - PRICE SHOWING UPWARD MOMENTUM"),
        ("trend = 'DOWN' AND close < vwap AND OBV < OBV_prv AND MACD_Histogram < 0",
         "SELL TREND - PRICE SHOWING DOWNWARD MOMENTUM"),
    ),
    default="HOLD (Neutral)",
)

RSI14 = RuleList(
    rules=(
        ("rsi_14 IS NULL", "NOT ENOUGH DATA"),
        ("rsi_14 <= 30", "BUY SIGNAL"),
        ("rsi_14 >= 70", "SELL SIGNAL"),
    ),
    default="HOLD",
)

CROSS = RuleList(
    rules=(
        ("rsi_14 <= 30 AND sma_crossover = 'GOLDEN CROSS'", "SUPER BUY (RSI<30 + Golden Cross)"),
        ("rsi_14 >= 70 AND sma_crossover = 'DEATH CROSS'", "SUPER SELL (RSI>70 + Death Cross)"),
        ("rsi_14 <= 30", "BUY SIGNAL - OVERSOLD (RSI < 30)"),
        ("rsi_14 >= 70", "SELL SIGNAL - OVERBOUGHT (RSI > 70)"),
        ("sma_crossover = 'GOLDEN CROSS'", "BUY SIGNAL - GOLDEN CROSS"),
        ("sma_crossover = 'DEATH CROSS'", "SELL SIGNAL - DEATH CROSS"),
        ("close < bb_lower", "WATCH BUY - BELOW LOWER BAND"),
        ("close > bb_upper", "WATCH SELL - ABOVE UPPER BAND"),
    ),
    default="HOLD",
)
