"""Gold: OHLCV candles per (symbol, tumbling event-time window).

Open and close are the prices of the first and last trade of the window
ordered by trade time, then trade id, then price (a trade without an id
comes after those with one) -- deterministic, unlike an unordered
first/last.  The order is the comparison of one struct of whole values, so
no id and no price is too large.  All aggregates are declarative, so Spark
computes partial candles on the map side and shuffles at most one row per
(symbol, window) per task; a hot symbol does not concentrate raw trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge import config
from tickforge.functions import order_fields
from tickforge.schemas import CANDLE_COLUMNS


def candle_aggregates() -> list[Column]:
    bm = F.col("is_buyer_maker")
    q = F.col("quantity")
    order = F.struct(*order_fields("trade_timestamp", "trade_id", "price"))
    return [
        F.min(order).getField("_o2").alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max(order).getField("_o2").alias("close_price"),
        F.sum(q).alias("total_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        # A NULL side counts in neither volume (it still counts in total).
        F.sum(F.when(bm == F.lit(False), q).otherwise(F.lit(0.0))).alias("buy_volume_taker"),
        F.sum(F.when(bm == F.lit(True), q).otherwise(F.lit(0.0))).alias("sell_volume_maker"),
    ]


def finish(agg: DataFrame, start: Column, ingested_at) -> DataFrame:
    """Candle columns, with the window's start and the time of ingestion."""
    if ingested_at is None:
        ing = F.current_timestamp()
    elif isinstance(ingested_at, Column):
        ing = ingested_at
    else:
        ing = F.lit(ingested_at).cast("timestamp")
    return agg.select(start.alias("candle_start_time"), "symbol",
                      *CANDLE_COLUMNS[2:-1], ing.alias("ingested_at"))


def candles(trades: DataFrame, width: str = config.CANDLE_WIDTH,
            ingested_at=None) -> DataFrame:
    """Batch candles of ``width`` (e.g. '1 minute', '1 hour')."""
    if "trade_id" not in trades.columns:
        trades = trades.withColumn("trade_id", F.lit(None).cast("long"))
    agg = (trades.groupBy(F.window("trade_timestamp", width).alias("window"), "symbol")
           .agg(*candle_aggregates()))
    return finish(agg, F.col("window.start"), ingested_at)


def candles_stream(trades: DataFrame, width: str = config.CANDLE_WIDTH,
                   delay: str = config.WATERMARK_DELAY, ingested_at=None) -> DataFrame:
    """Streaming candles: a window is emitted once, after the watermark
    (max event time - ``delay``) passes its end; later rows are dropped."""
    if "trade_id" not in trades.columns:
        trades = trades.withColumn("trade_id", F.lit(None).cast("long"))
    agg = (trades.withWatermark("trade_timestamp", delay)
           .groupBy(F.window("trade_timestamp", width).alias("window"), "symbol")
           .agg(*candle_aggregates()))
    return finish(agg, F.col("window.start"), ingested_at)
