"""The four analytical marts over the candle fact table.

Each mart is one function ``candles -> DataFrame`` with an explicit
``as_of`` clock where the upstream models read ``NOW()``.  They are
written in the shape Spark executes best rather than as literal CTEs:

* overview: a filter on the window's start, which reaches the scan and
  prunes files of a date-partitioned candle table, and one
  ``groupBy(symbol)`` instead of two window scans and two joins;
* OHLC summary: hourly figures attached with one window pass partitioned
  by (symbol, hour) instead of windowing, ranking and self-joining;
* pipeline health: candles are aggregated once, to a small hourly table
  that callers write; freshness and daily context are aggregates of it;
* price vs sentiment: the sentiment side (one row per day) is joined
  without a hint; AQE broadcasts it only after measuring it at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge import config
from tickforge.functions import (as_ts, candle_type, freshness_status,
                                 minutes_between, pct)
from tickforge.operators.sentiment import one_per_date


def health_order() -> list[Column]:
    """Newest hour first, then symbols."""
    return [F.col("ingestion_hour").desc_nulls_first(), F.col("symbol").asc_nulls_last()]


def prices_order() -> list[Column]:
    """Newest date first; equal dates by symbol."""
    return [F.col("date").desc_nulls_first(), F.col("symbol").asc_nulls_last()]


def market_overview(candles: DataFrame, as_of=None, window: str = config.OVERVIEW_WINDOW) -> DataFrame:
    """Rolling snapshot per symbol that has a candle since ``as_of - window``.

    The window has no upper bound (as upstream), so the latest candle of such
    a symbol lies in it and only the window's candles are read.  With a
    ``candle_date`` column (the stored candle table's partition) the date
    prunes files.  A NULL symbol matches nothing in an equi-join: its latest
    and first prices are NULL.
    """
    start = as_ts(as_of) - F.expr(f"INTERVAL {window}")
    t = F.col("candle_start_time")
    recent = candles.filter(t >= start)
    if "candle_date" in candles.columns:
        recent = recent.filter(F.col("candle_date") >= F.to_date(start))
    snap = recent.groupBy("symbol").agg(
        F.max_by("close_price", t).alias("_close"),
        F.max(t).alias("_latest"),
        F.min_by("open_price", t).alias("_open"),
        F.max("high_price").alias("high_24h"),
        F.min("low_price").alias("low_24h"),
        F.sum("total_volume").alias("volume_24h"),
        F.sum("buy_volume_taker").alias("buy_volume_24h"),
        F.sum("sell_volume_maker").alias("sell_volume_24h"),
        F.sum("trade_count").alias("total_trades_24h"),
    )

    return overview_columns(snap)


def overview_columns(snap: DataFrame) -> DataFrame:
    """The mart's columns of one row for each symbol."""

    def joined(c):
        return F.when(F.col("symbol").isNotNull(), F.col(c))

    cur, opn = joined("_close"), joined("_open")
    return snap.select(
        "symbol", cur.alias("current_price"), opn.alias("open_price_24h"), "high_24h", "low_24h",
        pct(cur - opn, opn, 2).alias("price_change_pct_24h"),
        (cur - opn).alias("price_change_24h"),
        "volume_24h", "buy_volume_24h", "sell_volume_24h",
        pct("buy_volume_24h", "volume_24h", 2).alias("buy_ratio_pct"),
        "total_trades_24h", joined("_latest").alias("last_updated"),
    )


def ohlc_summary(candles: DataFrame) -> DataFrame:
    """Per-candle features plus the figures of its (symbol, hour)."""
    t = F.col("candle_start_time")
    c = candles.select(
        *[F.col(x) for x in ["candle_start_time", "symbol", "open_price", "high_price",
                             "low_price", "close_price", "total_volume", "buy_volume_taker",
                             "sell_volume_maker", "trade_count"]],
        candle_type().alias("candle_type"),
        pct(F.abs(F.col("close_price") - F.col("open_price")), "open_price", 4).alias("body_size_pct"),
        pct("buy_volume_taker", "total_volume", 2).alias("buy_pressure_pct"),
        F.hour(t).alias("hour_of_day"),
        F.date_trunc("hour", t).alias("candle_hour"),
        F.date_trunc("day", t).alias("candle_date"),
    )
    hw = Window.partitionBy("symbol", "candle_hour")
    hourly = {
        # open of the hour's first candle, close of its last one
        "hourly_open": F.min_by("open_price", t).over(hw),
        "hourly_high": F.max("high_price").over(hw),
        "hourly_low": F.min("low_price").over(hw),
        "hourly_close": F.max_by("close_price", t).over(hw),
        "hourly_volume": F.sum("total_volume").over(hw),
        "hourly_buy_vol": F.sum("buy_volume_taker").over(hw),
        "hourly_sell_vol": F.sum("sell_volume_maker").over(hw),
        "hourly_trades": F.sum("trade_count").over(hw),
    }
    # An equi-join never matches NULL keys: such candles get NULL figures.
    keyed = F.col("symbol").isNotNull() & F.col("candle_hour").isNotNull()
    out = c.withColumns({k: F.when(keyed, v) for k, v in hourly.items()})
    return out.withColumn("hourly_buy_pct", pct("hourly_buy_vol", "hourly_volume", 2))


def hourly_ingestion(candles: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (candles.groupBy(F.date_trunc("hour", "candle_start_time").alias("ingestion_hour"),
                            "symbol")
            .agg(n.alias("candles_count"),
                 F.sum("trade_count").alias("total_trades"),
                 F.sum("total_volume").alias("total_volume"),
                 F.max("ingested_at").alias("last_ingested_at"),
                 F.min("candle_start_time").alias("earliest_candle"),
                 F.max("candle_start_time").alias("latest_candle"),
                 F.round(n / F.lit(float(config.CANDLES_PER_HOUR)) * F.lit(100.0), 1)
                 .alias("completeness_pct"),
                 (F.lit(config.CANDLES_PER_HOUR) - n).alias("missing_candles")))


def pipeline_health(candles: DataFrame, as_of=None, fresh: float = config.FRESH_MINUTES,
                    stale: float = config.STALE_MINUTES, ordered: bool = True,
                    hourly: DataFrame | None = None) -> DataFrame:
    """Completeness per (hour, symbol) with freshness and daily context.

    Freshness (per symbol) and daily context (per day) are aggregates of the
    small hourly table, combined before their shuffle, and joined back to it;
    AQE broadcasts each once it has measured it.  ``hourly`` is that table as
    written by the caller (``hourly_ingestion``); without it the plan shares
    one aggregate of the candles.  NULL symbols get no freshness and are not
    counted as active symbols, as with an equi-join and COUNT(DISTINCT).
    """
    if hourly is None:
        hourly = hourly_ingestion(candles)
    sym = F.col("symbol")
    keyed = hourly.withColumn("_day", F.date_trunc("day", "ingestion_hour"))
    latest = hourly.filter(sym.isNotNull()).groupBy("symbol").agg(
        F.max("latest_candle").alias("latest_candle_time"))
    daily = keyed.filter("_day IS NOT NULL").groupBy("_day").agg(
        F.sum("candles_count").alias("day_total_candles"),
        F.countDistinct("symbol").alias("day_active_symbols"))
    out = keyed.join(latest, "symbol", "left").join(daily, "_day", "left")
    mins = minutes_between(as_ts(as_of), F.col("latest_candle_time"))
    out = out.withColumns({
        "minutes_since_last_candle": mins,
        "freshness_status": F.when(F.col("latest_candle_time").isNotNull(),
                                   freshness_status(mins, fresh, stale)),
        "daily_completeness_pct": F.round(
            F.col("day_total_candles") / F.nullif(
                F.col("day_active_symbols") * F.lit(float(config.CANDLES_PER_DAY)), F.lit(0.0))
            * F.lit(100.0), 1),
    }).select("ingestion_hour", "symbol", "candles_count", "total_trades", "total_volume",
              "last_ingested_at", "earliest_candle", "latest_candle", "completeness_pct",
              "missing_candles", "latest_candle_time", "minutes_since_last_candle",
              "freshness_status", "day_total_candles", "day_active_symbols",
              "daily_completeness_pct")
    if ordered:
        out = out.orderBy(*health_order())
    return out


def price_vs_sentiment(candles: DataFrame, sentiment: DataFrame,
                       symbols=None, strip: str = config.SENTIMENT_MART_STRIP,
                       ordered: bool = True) -> DataFrame:
    """Daily price figures of the admitted symbols next to the index.

    Several readings of a date count as the newest one, so a day has one row.
    The label is ``upper(replace(symbol, strip, ''))``; the replace is
    case-sensitive, so 'BTCUSDT' and 'btcusdt' form two groups.
    """
    symbols = symbols or config.SENTIMENT_MART_SYMBOLS
    daily = (candles.filter(F.col("symbol").isin(*symbols))
             .groupBy(F.to_date("candle_start_time").alias("date"),
                      F.upper(F.replace(F.col("symbol"), F.lit(strip), F.lit(""))).alias("symbol"))
             .agg(F.avg("close_price").alias("avg_price"),
                  F.max("high_price").alias("max_price"),
                  F.min("low_price").alias("min_price"),
                  F.sum("total_volume").alias("total_volume")))
    sent = one_per_date(sentiment.withColumn("date", F.to_date("date"))).select(
        "date", "fng_value", "fng_classification")
    out = daily.join(sent, "date", "left").select(
        "date", "symbol", "avg_price", "max_price", "min_price", "total_volume",
        "fng_value", "fng_classification")
    if ordered:
        out = out.orderBy(*prices_order())
    return out
