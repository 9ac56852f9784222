"""Constraints of the lake's tables, checked after the marts are built."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickforge.operators.checks import Checked, accepted, fresh, holds, in_range, not_null, references, unique

CANDLE_KEY = ("symbol", "candle_start_time")


def candle_checks(rows: DataFrame) -> Checked:
    return Checked(rows, CANDLE_KEY, [
        *not_null("symbol", "candle_start_time", "open_price", "close_price"),
        holds("open_within", "open_price between low_price and high_price"),
        holds("close_within", "close_price between low_price and high_price"),
        holds("sides_within_volume", "buy_volume_taker + sell_volume_maker <= total_volume * 1.000000001"),
        in_range("trade_count", 1), in_range("low_price", 0), unique(*CANDLE_KEY)])


def sentiment_checks(rows: DataFrame) -> Checked:
    return Checked(rows, ("date",), [
        *not_null("date", "fng_value"), in_range("fng_value", 0, 100),
        accepted("fng_classification", "Extreme Fear", "Fear", "Neutral", "Greed", "Extreme Greed"), unique("date")])


def lake_checks(tables: dict[str, DataFrame], as_of, fresh_within: str = "24 hours") -> dict[str, Checked]:
    """Constraints of the candle table, the sentiment dimension and the four
    marts; ``tables``: frames by name."""
    candles, sentiment = tables["fact_market_candles"], tables["fact_market_sentiment"]
    overview, ohlc = tables["mart_market_overview"], tables["mart_ohlc_summary"]
    health, prices = tables["mart_pipeline_health"], tables["mart_price_vs_sentiment"]
    return {
        "fact_market_candles": candle_checks(candles),
        "fact_market_sentiment": sentiment_checks(sentiment),
        "mart_market_overview": Checked(overview, ("symbol",), [
            *not_null("symbol", "current_price"), holds("price_within", "current_price between low_24h and high_24h"),
            in_range("buy_ratio_pct", 0, 100), in_range("total_trades_24h", 1), unique("symbol"),
            fresh("last_updated", fresh_within, as_of), references(["symbol"], candles, ["symbol"], "candle_symbol")]),
        "mart_ohlc_summary": Checked(ohlc, CANDLE_KEY, [
            accepted("candle_type", "Bullish", "Bearish"), in_range("hour_of_day", 0, 23),
            holds("hour_holds_candle", "hourly_low <= low_price and high_price <= hourly_high"),
            unique(*CANDLE_KEY), references(list(CANDLE_KEY), candles, list(CANDLE_KEY), "candle")]),
        "mart_pipeline_health": Checked(health, ("ingestion_hour", "symbol"), [
            *not_null("ingestion_hour"), in_range("completeness_pct", 0, 100), in_range("missing_candles", 0, 60),
            accepted("freshness_status", "Fresh", "Stale", "Dead"), unique("ingestion_hour", "symbol")]),
        "mart_price_vs_sentiment": Checked(prices, ("date", "symbol"), [
            *not_null("date", "symbol"), holds("average_within", "avg_price between min_price * 0.999999999 and max_price * 1.000000001"),
            in_range("fng_value", 0, 100), unique("date", "symbol")]),
    }
