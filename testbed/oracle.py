"""The same results as plain SQL over the driver's tables, for a second engine to run."""

from __future__ import annotations

_TRADES = """trades AS (
  SELECT event_type AS symbol, value + 10000.0 AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         ts AS event_time, event_id
  FROM events)"""


def _candles(name: str = "candles", width: str = "1 HOUR") -> str:
    order = "(event_time, event_id)"
    return f"""{name} AS (
  SELECT symbol, arg_min(price, {order}) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, {order}) AS close, sum(quantity) AS volume, avg(price) AS avg_price,
         CASE WHEN sum(quantity) <> 0 THEN sum(price * quantity) / sum(quantity) END AS vwap,
         max(event_time) AS event_time,
         time_bucket(INTERVAL {width}, trades.event_time) AS window_start,
         time_bucket(INTERVAL {width}, trades.event_time) + INTERVAL {width} AS window_end
  FROM trades
  GROUP BY symbol, time_bucket(INTERVAL {width}, trades.event_time))"""


_FEATURES = """features AS (
  SELECT *, close - open AS price_change,
         CASE WHEN open <> 0 THEN (close - open) / open * 100 ELSE 0 END AS price_change_pct,
         CASE WHEN open <> 0 THEN (high - low) / open * 100 ELSE 0 END AS volatility,
         CASE WHEN close > open THEN 'UP' WHEN close < open THEN 'DOWN'
              ELSE 'SIDEWAYS' END AS trend,
         abs(close - open) AS body_size, high - low AS range_size,
         CASE WHEN high - low <> 0 THEN abs(close - open) / (high - low) ELSE 0 END
           AS candle_strength
  FROM candles)"""

_RISK = """CASE WHEN volatility >= 2 THEN 'HIGH' WHEN volatility >= 1 THEN 'MEDIUM'
  ELSE 'LOW' END AS risk_level"""

_SINGLE_RSI = """100 - 100 / (1 +
  (CASE WHEN close - open > 0 THEN close - open ELSE 0.001 END) /
  (CASE WHEN close - open < 0 THEN open - close ELSE 0.001 END)) AS rsi"""



def _half_up(value: str, digits: int) -> str:
    """Half-up on the decimal digits of a double; plain `round` works on its binary value and
    takes 8.1025 to 8.102."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


_W = "(PARTITION BY symbol ORDER BY event_time"


def _over(expr: str, before: int) -> str:
    return f"{expr} OVER {_W} ROWS BETWEEN {before} PRECEDING AND CURRENT ROW)"


def _change(source: str, digits: int | None = None) -> str:
    diff = f"close - lag(close) OVER {_W})"
    diff = diff if digits is None else _half_up(diff, digits)
    return f"""change AS (SELECT *, lag(close) OVER {_W}) AS prev_close, {diff} AS change
  FROM {source}),
moves AS (SELECT *, CASE WHEN change > 0 THEN change ELSE 0 END AS gain,
  CASE WHEN change < 0 THEN -change ELSE 0 END AS loss FROM change)"""


_RSI_WARM = f"""means AS (SELECT *, {_over("avg(gain)", 13)} AS g, {_over("avg(loss)", 13)} AS l,
  {_over("count(close)", 13)} AS filled FROM moves),
strength AS (SELECT *, CASE WHEN filled < 14 THEN NULL WHEN l = 0 THEN 100
  ELSE 100 - 100 / (1 + g / l) END AS rsi_14 FROM means)"""

_RSI_ROUNDED = f"""means AS (SELECT *, {_half_up(_over("avg(gain)", 13), 3)} AS g,
  {_half_up(_over("avg(loss)", 13), 3)} AS l FROM moves),
strength AS (SELECT *, CASE WHEN l = 0 THEN 100
  ELSE {_half_up("100 - 100 / (1 + g / l)", 3)} END AS RSI FROM means)"""


def _macd(source: str, fast: int = 12, slow: int = 26, signal: int = 9) -> str:
    line = f'{_over("avg(close)", fast - 1)} - {_over("avg(close)", slow - 1)}'
    return f"""macd AS (SELECT *, {line} AS macd_line FROM {source}),
signal AS (SELECT *, {_over("avg(macd_line)", signal - 1)} AS signal_line FROM macd),
histogram AS (SELECT *, {_half_up("macd_line - signal_line", 3)} AS MACD_Histogram FROM signal)"""


def _spike(source: str) -> str:
    return f"""volumes AS (SELECT *,
  avg(volume) OVER {_W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS past_volume FROM {source}),
spikes AS (SELECT *, CAST(CASE WHEN volume > past_volume * 1.5 THEN 1 ELSE 0 END AS INTEGER)
  AS Volume_Spike FROM volumes)"""


def _band_stats(source: str, n: int = 20) -> str:
    return f"""stats AS (SELECT *, {_over("avg(close)", n - 1)} AS mid,
  {_over("stddev_samp(close)", n - 1)} AS dev,
  {_over("count(close)", n - 1)} >= {n} AS full_band FROM {source})"""


_BANDS_ROUNDED = f"""bands AS (SELECT *, {_half_up("mid + 2 * dev", 3)} AS BB_Upper,
  {_half_up("mid - 2 * dev", 3)} AS BB_Lower FROM stats)"""

_BANDS_WARM = """warm AS (SELECT *, CASE WHEN full_band THEN mid END AS bb_middle,
  CASE WHEN full_band THEN mid + 2 * dev END AS bb_upper,
  CASE WHEN full_band THEN mid - 2 * dev END AS bb_lower FROM stats),
bands AS (SELECT *, CASE WHEN bb_upper IS NULL THEN 'NOT ENOUGH DATA'
  WHEN close > bb_upper THEN 'ABOVE UPPER BAND' WHEN close < bb_lower THEN 'BELOW LOWER BAND'
  ELSE 'INSIDE BAND' END AS bb_signal FROM warm)"""


def _obv(source: str) -> str:
    return f"""steps AS (SELECT *, close - lag(close) OVER {_W}) AS step FROM {source}),
signed AS (SELECT *, CASE WHEN step > 0 THEN volume WHEN step < 0 THEN -volume ELSE 0 END
  AS v FROM steps),
totals AS (SELECT *, CAST(round(sum(CAST(v AS DECIMAL(28, 10))) OVER {_W}
  ROWS UNBOUNDED PRECEDING), 3) AS DOUBLE) AS OBV FROM signed),
obvs AS (SELECT *, lag(OBV) OVER {_W}) AS OBV_prv FROM totals)"""


def _cross(source: str, digits: int | None = None, short: int = 9, long: int = 21) -> str:
    near, far = f"sma_{short}", f"sma_{long}"
    gap = f"{near} - {far}" if digits is None else f"round({near} - {far}, {digits})"

    def mean(n: int) -> str:
        return f'CASE WHEN {_over("count(close)", n - 1)} >= {n} THEN {_over("avg(close)", n - 1)} END'

    return f"""smas AS (SELECT *, {mean(short)} AS {near}, {mean(long)} AS {far} FROM {source}),
gaps AS (SELECT *, {gap} AS gap FROM smas),
lagged AS (SELECT *, lag(gap) OVER {_W}) AS prev_gap FROM gaps),
crossed AS (SELECT *, CASE WHEN {near} IS NULL OR {far} IS NULL THEN 'NOT ENOUGH DATA'
  WHEN prev_gap <= 0 AND gap > 0 THEN 'GOLDEN CROSS'
  WHEN prev_gap >= 0 AND gap < 0 THEN 'DEATH CROSS'
  WHEN gap > 0 THEN 'SMA{short} ABOVE SMA{long}' WHEN gap < 0 THEN 'SMA{short} BELOW SMA{long}'
  ELSE 'NO CROSS' END AS sma_crossover FROM lagged)"""


# The five rule lists, written out (fixed values).
_ADVICE_BASIC = """CASE
  WHEN rsi >= 70
    THEN 'STRONG SELL (Overbought)'
  WHEN rsi <= 30
    THEN 'STRONG BUY (Oversold)'
  ELSE 'HOLD (Neutral)' END AS advice"""

_ADVICE_VWAP = """CASE
  WHEN rsi <= 30 AND trend = 'UP' AND risk_level <> 'HIGH'
    THEN 'STRONG BUY (Oversold + Uptrend)'
  WHEN rsi <= 30 AND risk_level = 'HIGH'
    THEN 'WATCH BUY - HIGH RISK'
  WHEN rsi >= 70 AND trend = 'DOWN'
    THEN 'STRONG SELL (Overbought + Downtrend)'
  WHEN rsi >= 70
    THEN 'SELL WARNING (Overbought)'
  WHEN volatility >= 2
    THEN 'HOLD - HIGH VOLATILITY'
  WHEN close > vwap AND trend = 'UP'
    THEN 'BUY SIGNAL (Above VWAP)'
  WHEN close < vwap AND trend = 'DOWN'
    THEN 'SELL SIGNAL (Below VWAP)'
  ELSE 'HOLD (Neutral)' END AS advice"""

_ADVICE_MULTI = """CASE
  WHEN risk_level = 'HIGH'
    THEN 'EXTREME RISK - AVOID TRADING'
  WHEN price_change_pct > 5 AND close > BB_Upper AND OBV < 0 AND Volume_Spike = 0
    THEN 'POTENTIAL BULL TRAP - CAUTION ADVISED'
  WHEN close <= BB_Lower AND RSI < 30 AND Volume_Spike = 1 AND OBV > OBV_prv AND MACD_Histogram > 0 AND candle_strength > 0.7
    THEN 'STRONG BUY SIGNAL - POTENTIAL REVERSAL FROM THE BOTTOM'
  WHEN close >= BB_Upper AND RSI > 70 AND Volume_Spike = 1 AND OBV < OBV_prv AND MACD_Histogram < 0 AND candle_strength > 0.7
    THEN 'STRONG SELL SIGNAL - POTENTIAL REVERSAL FROM THE TOP'
  WHEN trend = 'UP' AND close > vwap AND close <= BB_Upper AND OBV > OBV_prv AND MACD_Histogram > 0 AND RSI BETWEEN 40 AND 65 AND risk_level <> 'HIGH' AND volatility < 2
    THEN 'BUY TREND - PRICE SHOWING UPWARD MOMENTUM'
  WHEN trend = 'DOWN' AND close < vwap AND OBV < OBV_prv AND MACD_Histogram < 0
    THEN 'SELL TREND - PRICE SHOWING DOWNWARD MOMENTUM'
  ELSE 'HOLD (Neutral)' END AS advice"""

_ADVICE_RSI14 = """CASE
  WHEN rsi_14 IS NULL
    THEN 'NOT ENOUGH DATA'
  WHEN rsi_14 <= 30
    THEN 'BUY SIGNAL'
  WHEN rsi_14 >= 70
    THEN 'SELL SIGNAL'
  ELSE 'HOLD' END AS advice"""

_ADVICE_CROSS = """CASE
  WHEN rsi_14 <= 30 AND sma_crossover = 'GOLDEN CROSS'
    THEN 'SUPER BUY (RSI<30 + Golden Cross)'
  WHEN rsi_14 >= 70 AND sma_crossover = 'DEATH CROSS'
    THEN 'SUPER SELL (RSI>70 + Death Cross)'
  WHEN rsi_14 <= 30
    THEN 'BUY SIGNAL - OVERSOLD (RSI < 30)'
  WHEN rsi_14 >= 70
    THEN 'SELL SIGNAL - OVERBOUGHT (RSI > 70)'
  WHEN sma_crossover = 'GOLDEN CROSS'
    THEN 'BUY SIGNAL - GOLDEN CROSS'
  WHEN sma_crossover = 'DEATH CROSS'
    THEN 'SELL SIGNAL - DEATH CROSS'
  WHEN close < bb_lower
    THEN 'WATCH BUY - BELOW LOWER BAND'
  WHEN close > bb_upper
    THEN 'WATCH SELL - ABOVE UPPER BAND'
  ELSE 'HOLD' END AS advice"""

# Row limits and titles of the panels (fixed values).
_CHART_ROWS, _INDICATOR_ROWS, _TABLE_ROWS = 500, 300, 15
_BAND_TITLES = {
    "close": "Giá đóng cửa",
    "bb_upper": "BB Thượng (Upper)",
    "bb_middle": "BB Trung dung (Middle)",
    "bb_lower": "BB Hạ (Lower)",
}
_SMA_RSI_TITLES = {
    "sma_9": "SMA 9 (Ngắn hạn)",
    "sma_21": "SMA 21 (Dài hạn)",
    "rsi_14": "Sức mạnh RSI-14",
}
_SIGNAL_TITLES = {
    "event_time": "Thời gian (UTC)",
    "symbol": "Cặp tỷ giá",
    "close": "Giá đóng",
    "bb_signal": "Trạng thái Bollinger",
    "sma_crossover": "Giao cắt SMA",
    "advice": "Chiến lược khuyến nghị",
}


def _edge(value: str) -> str:
    """Six digits, as `edge` in the queries: noise goes at the ninth digit, then half-up. Adding
    0 turns a negative zero into zero."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 9)), 6) AS DOUBLE) + 0.0"


def _r(*names: str) -> str:
    return ", ".join(f"{_edge(n)} AS {n}" for n in names)


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join((_TRADES, *parts)) + "\n" + select


_OHLC = ("open", "high", "low", "close")
_PRICES = (*_OHLC, "volume", "avg_price", "vwap")
_MOVES = ("price_change", "price_change_pct", "volatility", "candle_strength")
_CANDLE_ROW = f"symbol, event_time, window_start, window_end, {_r(*_PRICES)}"

_MULTI_PARTS = (
    _candles(), _FEATURES, f"risks AS (SELECT *, {_RISK} FROM features)",
    _change("risks", 3), _RSI_ROUNDED, _macd("strength"), _spike("histogram"),
    _band_stats("spikes"), _BANDS_ROUNDED, _obv("bands"),
    f"labels AS (SELECT *, {_ADVICE_MULTI} FROM obvs)",
)
_MULTI_ROW = (
    f"symbol, event_time, trend, risk_level, Volume_Spike, advice, "
    + _r(*_PRICES, *_MOVES, "RSI", "MACD_Histogram", "BB_Upper", "BB_Lower", "OBV")
)
_CROSS_PARTS = (
    _candles(), _FEATURES, _band_stats("features"), _BANDS_WARM, _cross("bands"),
    _change("crossed"), _RSI_WARM,
    f"labels AS (SELECT *, {_ADVICE_CROSS} FROM strength)",
)
_CROSS_ROW = (
    "symbol, event_time, window_start, window_end, trend, bb_signal, sma_crossover, advice, "
    + _r(*_PRICES, *_MOVES, "bb_middle", "bb_upper", "bb_lower", "sma_9", "sma_21", "rsi_14")
)
_VWAP_PARTS = (
    _candles(), _FEATURES,
    f"scored AS (SELECT *, {_SINGLE_RSI}, {_RISK} FROM features)",
    f"labels AS (SELECT *, {_ADVICE_VWAP} FROM scored)",
)
_VWAP_ROW = (
    "symbol, event_time, window_start, window_end, trend, risk_level, advice, "
    + _r(*_PRICES, *_MOVES, "rsi")
)
# What a stream has closed: windows that ended an hour (its delay) before the newest trade.
_CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"

_MIXED_PARTS = (
    *_VWAP_PARTS, _candles("sixes", "6 HOURS"),
    f"basic AS (SELECT *, {_SINGLE_RSI} FROM sixes)",
    f"basic_labels AS (SELECT *, {_ADVICE_BASIC} FROM basic)",
    """mixed AS (
  SELECT symbol, open, high, low, close, volume, vwap, rsi, advice, event_time, window_start
  FROM labels
  UNION ALL
  SELECT symbol, open, high, low, close, NULL, NULL, rsi, advice, event_time, NULL
  FROM basic_labels)""",
)


def _newest(source: str, time: str, n: int, where: str = "TRUE") -> str:
    return f"""newest AS (SELECT *, {time} AS time FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY {time} DESC) <= {n})"""


def _chart(time: str, columns: tuple[str, ...], where: str) -> str:
    return _with(
        *_MIXED_PARTS, _newest("mixed", time, _CHART_ROWS, where),
        select=f"SELECT symbol, time, advice, {_r(*columns)} FROM newest",
    )


def _panel(n: int, titles: dict[str, str], lead: str = "symbol, time, ", where: str = "TRUE") -> str:
    numbers = {"close", "bb_upper", "bb_middle", "bb_lower", "sma_9", "sma_21", "rsi_14"}
    columns = ", ".join(
        f'{_edge(c) if c in numbers else c} AS "{title}"'
        for c, title in titles.items()
    )
    return _with(
        *_CROSS_PARTS, _newest("labels", "event_time", n, where), select=f"SELECT {lead}{columns} FROM newest"
    )


def _rolling(*parts: str, last: str, columns: tuple[str, ...], plain: str = "") -> str:
    return _with(
        _candles(), *parts,
        select=f"SELECT symbol, event_time, {plain}{_r(*columns)} FROM {last}",
    )


_STUDENTS = """WITH students AS (
  SELECT o_orderkey AS student,
         CASE WHEN o_orderstatus = 'P' THEN 'no' ELSE 'yes' END AS higher,
         o_orderpriority AS Mjob,
         CASE WHEN o_orderstatus = 'O' THEN 'yes' ELSE 'no' END AS romantic,
         CASE WHEN o_orderpriority < '3' THEN 'U' ELSE 'R' END AS address,
         CAST(floor(o_totalprice / 25000) AS INTEGER) AS G3,
         CAST(month(o_orderdate) % 4 + 1 AS INTEGER) AS studytime,
         CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS Dalc,
         CAST(quarter(o_orderdate) AS INTEGER) AS Walc,
         CAST(dayofmonth(o_orderdate) AS INTEGER) AS absences,
         CAST(month(o_orderdate) % 5 + 1 AS INTEGER) AS goout
  FROM orders)
"""

# White space, as in the word-count report.
_BREAKS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_WORDS = f"""WITH words AS (
  SELECT unnest(string_split_regex(text, '[{_BREAKS}]+')) AS word FROM documents),
counts AS (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word)
"""

_REVENUE = """WITH sales AS (
  SELECT n_name AS Country, round(l_quantity * (l_extendedprice / l_quantity), 2) AS money
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
totals AS (SELECT Country, sum(money) AS total FROM sales GROUP BY Country)
"""
_RANKED = "FROM totals WHERE Country <> 'UNITED KINGDOM' ORDER BY total DESC, Country LIMIT "

_K = "json_extract_string(props, '$.k')"
_RAW = f"""'{{"s":"' || event_type || '","p":"' ||
  CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END || '"' ||
  CASE WHEN event_type = 'purchase' AND value < 1 THEN '' ELSE ',"q":"' || {_K} || '"' END ||
  ',"E":' || (epoch_us(ts) // 1000) || '}}'"""
_BAD = "event_type = 'error' OR (event_type IN ('purchase', 'signup') AND value < 1)"

_FRACTIONAL = f"""fractional AS (SELECT * REPLACE (
  {_half_up("volume * (close - 10000.0) / 7000", 8)} AS volume) FROM candles)"""

ORACLE: dict[str, str] = {
    "trades_decode": f"""SELECT event_type AS symbol, round(value, 6) AS price,
  CAST({_K} AS DOUBLE) AS quantity, (epoch_us(ts) // 1000) AS timestamp,
  make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time,
  round(value * CAST({_K} AS DOUBLE), 6) AS price_volume FROM events""",
    "trades_normalize": f"""SELECT event_type AS symbol, value AS price,
  CAST({_K} AS DOUBLE) AS quantity, (epoch_us(ts) // 1000) AS timestamp FROM events WHERE NOT ({_BAD})""",
    "trades_rejects": f"""SELECT CASE WHEN event_type = 'signup' THEN 'ping' ELSE {_RAW} END AS value,
  CASE event_type WHEN 'signup' THEN 'unreadable message' WHEN 'error' THEN 'no usable price'
  ELSE 'no usable quantity' END AS reason FROM events WHERE {_BAD}""",
    "topic_payload": f"""SELECT '{{"symbol":"' || event_type || '","price":' || value ||
  ',"quantity":' || CAST({_K} AS DOUBLE) || ',"timestamp":' || (epoch_us(ts) // 1000) || '}}' AS value
  FROM events""",
    "candles_1h": _with(_candles(), select=f"SELECT {_CANDLE_ROW} FROM candles"),
    "candles_6h": _with(
        _candles(width="6 HOURS"), select=f"SELECT {_CANDLE_ROW} FROM candles"
    ),
    "candles_tie_break": _with(_candles(), select=f"SELECT {_CANDLE_ROW} FROM candles"),
    "candle_features": _with(
        _candles(), _FEATURES,
        select=f"SELECT symbol, event_time, trend, {_r(*_MOVES, 'body_size', 'range_size')}"
        " FROM features",
    ),
    "candle_risk": _with(
        _candles(), _FEATURES,
        select=f"SELECT symbol, event_time, {_RISK}, {_r('volatility')} FROM features",
    ),
    "rsi_single_candle": _with(
        _candles(), f"scored AS (SELECT *, {_SINGLE_RSI} FROM candles)",
        select=f"SELECT symbol, event_time, {_r('close', 'rsi')} FROM scored",
    ),
    "close_change": _rolling(
        _change("candles"), last="moves", columns=("prev_close", "change", "gain", "loss")
    ),
    "rsi_rounded": _rolling(
        _change("candles", 3), _RSI_ROUNDED, last="strength", columns=("RSI",)
    ),
    "rsi14_warm": _rolling(_change("candles"), _RSI_WARM, last="strength", columns=("rsi_14",)),
    "macd_sma": _rolling(
        _macd("candles"), last="histogram",
        columns=("macd_line", "signal_line", "MACD_Histogram"),
    ),
    "macd_wide_split": _rolling(
        _macd("candles", 50, 100, 20), last="histogram", columns=("macd_line", "signal_line"),
    ),
    "bollinger_wide_split": _rolling(
        _band_stats("candles", 100), _BANDS_WARM, last="bands",
        columns=("bb_middle", "bb_upper", "bb_lower"),
    ),
    "sma_cross_wide_split": _rolling(
        _cross("candles", 9, 50, 200), last="crossed", columns=("sma_50", "sma_200"),
        plain="sma_crossover, ",
    ),
    "obv_fractional": _rolling(
        _FRACTIONAL, _obv("fractional"), last="obvs", columns=("volume", "OBV")
    ),
    "volume_spike": _rolling(
        _spike("candles"), last="spikes", columns=("past_volume",), plain="Volume_Spike, "
    ),
    "bollinger_rounded": _rolling(
        _band_stats("candles"), _BANDS_ROUNDED, last="bands", columns=("BB_Upper", "BB_Lower")
    ),
    "bollinger_warm": _rolling(
        _band_stats("candles"), _BANDS_WARM, last="bands",
        columns=("bb_middle", "bb_upper", "bb_lower"),
    ),
    "band_signal": _rolling(
        _band_stats("candles"), _BANDS_WARM, last="bands", columns=("close",),
        plain="bb_signal, ",
    ),
    "obv": _rolling(_obv("candles"), last="obvs", columns=("volume", "OBV")),
    "obv_prev": _rolling(_obv("candles"), last="obvs", columns=("OBV_prv",)),
    "sma_cross": _rolling(
        _cross("candles", 9), last="crossed", columns=("sma_9", "sma_21"),
        plain="sma_crossover, ",
    ),
    "advice_basic": _with(
        _candles(), f"scored AS (SELECT *, {_SINGLE_RSI} FROM candles)",
        select=f"SELECT symbol, event_time, {_ADVICE_BASIC}, {_r(*_OHLC, 'rsi')}"
        " FROM scored",
    ),
    "advice_vwap": _with(*_VWAP_PARTS, select=f"SELECT {_VWAP_ROW} FROM labels"),
    "advice_multi": _with(*_MULTI_PARTS, select=f"SELECT {_MULTI_ROW} FROM labels"),
    "advice_rsi14": _rolling(
        _change("candles"), _RSI_WARM, last="strength", columns=(*_PRICES, "rsi_14"),
        plain=f"{_ADVICE_RSI14}, ",
    ),
    "advice_stored_rsi14": _with(
        _candles(),
        """near AS (SELECT * FROM candles WHERE symbol IN ('click', 'view', 'purchase')
  AND event_time >= (SELECT max(ts) FROM events) - INTERVAL 96 HOURS)""",
        _change("near"), _RSI_WARM,
        select=f"SELECT symbol, event_time, {_ADVICE_RSI14}, {_r(*_PRICES, 'rsi_14')} FROM strength",
    ),
    "advice_cross": _with(*_CROSS_PARTS, select=f"SELECT {_CROSS_ROW} FROM labels"),
    "chart_event_time": _with(
        *_VWAP_PARTS, _newest("labels", "event_time", _CHART_ROWS),
        select=f"SELECT symbol, time, advice, {_r(*_OHLC, 'rsi')} FROM newest",
    ),
    "chart_window_start": _chart(
        "window_start", (*_OHLC, "volume", "vwap", "rsi"), "window_start IS NOT NULL"
    ),
    "chart_fallback_time": _chart(
        "coalesce(window_start, event_time)", (*_OHLC, "volume", "vwap", "rsi"),
        "window_start IS NOT NULL OR event_time IS NOT NULL",
    ),
    "panel_bands": _panel(_INDICATOR_ROWS, _BAND_TITLES),
    "panel_sma_rsi": _panel(_INDICATOR_ROWS, _SMA_RSI_TITLES),
    "table_signals": _panel(_TABLE_ROWS, _SIGNAL_TITLES, lead=""),
    "latest_per_symbol": _with(
        _candles(), _newest("candles", "event_time", 100),
        select=f"SELECT {_CANDLE_ROW} FROM newest",
    ),
    "table_count": _with(_candles(), select="SELECT count(*) AS n FROM candles"),
    "latest_five": _with(
        _candles(), select=f"SELECT {_CANDLE_ROW} FROM candles ORDER BY event_time DESC LIMIT 5"
    ),
    "recent_lookback": _with(
        _candles(),
        select=f"SELECT {_CANDLE_ROW} FROM candles"
        " WHERE event_time >= (SELECT max(ts) FROM events) - INTERVAL 48 HOURS",
    ),
    "revenue_by_country": f"""{_REVENUE}SELECT Country, round(total, 2) AS Total_Revenue
  {_RANKED}10""",
    "top_country": f"{_REVENUE}SELECT Country {_RANKED}1",
    "grade_filter": _STUDENTS + "SELECT * FROM students WHERE higher = 'yes' AND G3 < 10",
    "study_count": _STUDENTS + "SELECT count(*) AS n FROM students WHERE studytime = 4",
    "grade_by_job": _STUDENTS
    + "SELECT Mjob, round(avg(G3), 6) AS Avg_G3 FROM students GROUP BY Mjob",
    "grade_by_status": _STUDENTS
    + "SELECT romantic, round(avg(G3), 6) AS Avg_G3 FROM students GROUP BY romantic",
    "total_alcohol": _STUDENTS + "SELECT student, Dalc + Walc AS Total_Alcohol FROM students",
    "grade_class": _STUDENTS + """SELECT student, G3, CASE WHEN G3 >= 15 THEN 'Gioi'
  WHEN G3 >= 10 THEN 'Kha' ELSE 'Yeu' END AS Rank FROM students""",
    "sql_absentees": _STUDENTS
    + "SELECT * FROM students WHERE absences > 10 AND G3 < 10 AND goout > 4",
    "sql_by_address": _STUDENTS + """SELECT address, round(avg(G3), 6) AS Average_G3,
  count(*) AS Student_Count FROM students GROUP BY address""",
    "word_count": _WORDS + "SELECT word, n FROM counts",
    "word_lines": _WORDS + "SELECT word || chr(9) || n AS value FROM counts",
    "pair_sum": f"""SELECT event_type AS word, CAST(sum(CAST({_K} AS BIGINT)) AS BIGINT) AS n
  FROM events WHERE value >= 1 AND value <= 100 GROUP BY event_type""",
    "text_pairs": _WORDS + "SELECT word, n FROM counts",
    "csv_revenue": """WITH totals AS (SELECT CAST(l_suppkey AS VARCHAR) AS Country,
  sum(round(l_quantity * (l_extendedprice / l_quantity), 2)) AS total FROM lineitem GROUP BY 1)
SELECT Country, round(total, 2) AS Total_Revenue FROM totals ORDER BY total DESC, Country
LIMIT 10""",
    "csv_students": _STUDENTS
    + "SELECT address, round(avg(G3), 6) AS Avg_G3 FROM students GROUP BY address",
    "store_tail": _with(
        _candles(), _newest("candles", "event_time", 33),
        select=f"SELECT {_CANDLE_ROW} FROM newest",
    ),
    "stream_candles": _with(
        *_VWAP_PARTS, select=f"SELECT {_VWAP_ROW} FROM labels WHERE {_CLOSED}"
    ),
    "stream_indicators": _with(
        *_CROSS_PARTS, select=f"SELECT {_CROSS_ROW} FROM labels WHERE {_CLOSED}"
    ),
    "stream_multi": _with(
        *_MULTI_PARTS, select=f"SELECT {_MULTI_ROW} FROM labels WHERE {_CLOSED}"
    ),
    "stream_late_drop": _with(
        _candles(),
        f"""closed AS (SELECT symbol, count(*) AS candles FROM candles WHERE {_CLOSED}
  GROUP BY symbol)""",
        """late AS (SELECT event_type AS symbol, count(*) AS late FROM events
  WHERE event_type = 'purchase' AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
    <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1)""",
        select="""SELECT symbol, candles, coalesce(late, 0) AS late
  FROM closed LEFT JOIN late USING (symbol)""",
    ),
    # Trades of closed windows once; the first quarter's purchases and the second's errors again.
    "stream_late_continuous": """WITH span AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events),
parts AS (SELECT event_type AS symbol, floor((epoch_us(ts) - a) * 4 / (b - a + 1)) AS part,
    time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
      <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) AS closed
  FROM events, span),
fates AS (SELECT symbol, count(*) AS n, count(*) FILTER (closed) AS counted,
    count(*) FILTER (part = 0 AND symbol = 'purchase') AS late,
    count(*) FILTER (part = 1 AND symbol = 'error') AS unusable
  FROM parts GROUP BY symbol)
SELECT symbol, n + late + unusable AS trades, counted, late, unusable FROM fates""",
}
ORACLE["advice_stored_multi"] = _with(*_MULTI_PARTS, select=f"""SELECT {_MULTI_ROW} FROM labels
  WHERE symbol IN ('click', 'view', 'purchase')
    AND event_time >= (SELECT max(ts) FROM events) - INTERVAL 96 HOURS""")
ORACLE["panel_multi"] = _with(
    *_MULTI_PARTS, _newest("labels", "event_time", _INDICATOR_ROWS),
    select=f"SELECT {_MULTI_ROW} FROM newest",
)
ORACLE["csv_inferred"] = _STUDENTS + """SELECT address,
  round(avg(G3 + CASE WHEN student = 1 THEN 0.5 ELSE 0 END), 6) AS Avg_G3,
  CAST(sum(absences) AS BIGINT) AS absences, count(*) FILTER (student % 2 = 0) AS goout, max(Mjob) AS Mjob,
  'double' AS grade_type, 'int' AS absences_type FROM students GROUP BY address"""
ORACLE["panel_live"] = _panel(_INDICATOR_ROWS, _BAND_TITLES, where=_CLOSED)
# Same results by another way of computing them.
ORACLE["panel_bands_stored"] = ORACLE["panel_bands"]
ORACLE["obv_fractional_split"] = ORACLE["obv_fractional"]
ORACLE["advice_multi_split"] = ORACLE["advice_multi"]
ORACLE["advice_cross_split"] = ORACLE["advice_cross"]
ORACLE["store_published"] = ORACLE["advice_rsi14"]
ORACLE["stream_multi_split"] = ORACLE["stream_multi"]
ORACLE["stream_indicators_state"] = ORACLE["stream_indicators"]
ORACLE["stream_multi_state"] = ORACLE["stream_multi"]
ORACLE["candles_rollup"] = ORACLE["candles_6h"]
ORACLE["store_compacted"] = ORACLE["candles_1h"]
ORACLE["stream_audit_incremental"] = ORACLE["stream_late_continuous"]
ORACLE["sink_replayed"] = ORACLE["advice_rsi14"]
