"""Mergeable candles: partial states of (symbol, window) keys.

A state holds the first and the last trade of its window as ordered structs
(trade time, id, price), the extremes, sums and count.  States of any parts of
the trades merge into the state of all of them, in any order, so trades that
come after their window has been published change that window's row only: no
watermark is needed, and nothing is late.  (Sums are of doubles: their last
bits depend on the order of merging.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import config, schemas
from tickforge.functions import order_fields
from tickforge.operators.candles import finish
from tickforge.sources.buckets import BucketTable

KEY = ["candle_start_time", "symbol"]


def partial_candles(trades: DataFrame, width: str = config.CANDLE_WIDTH) -> DataFrame:
    """States of a set of trades; combined on the map side."""
    if "trade_id" not in trades.columns:
        trades = trades.withColumn("trade_id", F.lit(None).cast("long"))
    order = F.struct(*order_fields("trade_timestamp", "trade_id", "price"))
    maker, q = F.col("is_buyer_maker"), F.col("quantity")

    def side(is_maker: bool) -> Column:
        return F.sum(F.when(maker == F.lit(is_maker), q).otherwise(F.lit(0.0)))

    agg = trades.groupBy(F.window("trade_timestamp", width).alias("w"), "symbol").agg(
        F.min(order).alias("first"), F.max(order).alias("last"), F.max("price").alias("high_price"),
        F.min("price").alias("low_price"), F.sum(q).alias("total_volume"), side(False).alias("buy_volume_taker"),
        side(True).alias("sell_volume_maker"), F.count(F.lit(1)).alias("trade_count"))
    return agg.withColumn("candle_start_time", F.col("w.start")).select(*schemas.PARTIAL_CANDLE.fieldNames())


def merge(*states: DataFrame) -> DataFrame:
    """One state for each key."""
    every = states[0].select(*schemas.PARTIAL_CANDLE.fieldNames())
    for s in states[1:]:
        every = every.unionByName(s.select(*schemas.PARTIAL_CANDLE.fieldNames()))
    sums = ["total_volume", "buy_volume_taker", "sell_volume_maker", "trade_count"]
    return every.groupBy(*KEY).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"), *[F.sum(c).alias(c) for c in sums]).select(*schemas.PARTIAL_CANDLE.fieldNames())


def coarser(states: DataFrame, unit: str) -> DataFrame:
    """States of longer calendar windows (``hour``, ``day``) from shorter ones."""
    return merge(states.withColumn("candle_start_time", F.date_trunc(unit, "candle_start_time")))


def candles_from(states: DataFrame, ingested_at=None) -> DataFrame:
    """Candles of merged states."""
    return finish(states.withColumns({"open_price": F.col("first._o2"), "close_price": F.col("last._o2")}),
                  F.col("candle_start_time"), ingested_at)


def stored(spark: SparkSession, path: str) -> BucketTable:
    """The stored states, one bucket a day: a merge reads and writes the days
    of its trades."""
    return BucketTable(spark, path, schemas.PARTIAL_CANDLE, F.date_format("candle_start_time", "yyyy-MM-dd"))


class PartialCandleSink:
    """Micro-batches of silver trades -> merged states.  A batch is applied
    once, also if it is replayed: its number is committed with its rows."""

    def __init__(self, path: str, run: str, width: str = config.CANDLE_WIDTH):
        self.path, self.run, self.width = path, run, width

    def __call__(self, trades: DataFrame, batch_id: int) -> None:
        stored(trades.sparkSession, self.path).merge(partial_candles(trades, self.width), merge, (self.run, batch_id))
