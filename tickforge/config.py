"""Fixed values and defaults.

Values under "fixed values" must stay as they are for results to match
the upstream pipeline this library re-implements; the rest are defaults
that callers may override through function arguments.
"""

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream pipeline's for equal results)
# ---------------------------------------------------------------------------
# Tag written into every normalised trade message.
SOURCE_TAG = "binance_aggTrade"
# Silver quality filter: price must be below this cap.
PRICE_CAP = 1_000_000
# Silver enrichment: a trade is large when trade_value exceeds this.
LARGE_TRADE_VALUE = 10_000
# Rounding scales.
PRICE_SCALE = 8          # price, quantity, trade_value
MAGNITUDE_SCALE = 2      # price_magnitude
# Event-time watermark delay for silver de-duplication and gold candles.
WATERMARK_DELAY = "10 minutes"
# Candle width.
CANDLE_WIDTH = "1 minute"
# Silver de-duplication key.
DEDUPE_KEY = ["symbol", "trade_timestamp", "price", "quantity"]
# Completeness denominators: candles per symbol-hour and per symbol-day.
CANDLES_PER_HOUR = 60
CANDLES_PER_DAY = 24 * 60
# Freshness thresholds in minutes: <= 5 Fresh, <= 30 Stale, else Dead.
FRESH_MINUTES = 5
STALE_MINUTES = 30
# Rolling overview window.
OVERVIEW_WINDOW = "24 hours"
# Symbols admitted by the price-vs-sentiment mart, and the text removed
# (case-sensitively) before upper-casing the label.
SENTIMENT_MART_SYMBOLS = ["BTCUSDT", "btcusdt"]
SENTIMENT_MART_STRIP = "usdt"
# Fear & Greed classification upper bounds used by the test fixture.
FNG_CLASSES = [(24, "Extreme Fear"), (44, "Fear"), (55, "Neutral"),
               (75, "Greed"), (100, "Extreme Greed")]
