"""The rolling overview from stored hourly states.

The window of a moving clock is made of whole hours and, at its older end, the
rest of one hour: the whole hours come from hourly states (one row for each
symbol and hour), the rest from that hour's minute states.  So a snapshot of 24
hours reads about 24 rows and at most 59 minutes for each symbol, however many
trades or candles the hours have.  Both tables are kept in day buckets, and
only the window's days are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import config
from tickforge.functions import as_ts
from tickforge.operators import marts, partials
from tickforge.sources.buckets import BucketTable


def window_parts(hours: DataFrame, minutes: DataFrame, as_of=None, window: str = config.OVERVIEW_WINDOW) -> DataFrame:
    """States that together are the window: minutes up to the first full hour,
    then hours (the window has no end, as upstream)."""
    start = as_ts(as_of) - F.expr(f"INTERVAL {window}")
    hour = F.date_trunc("hour", start)
    full = F.when(hour < start, hour + F.expr("INTERVAL 1 HOUR")).otherwise(hour)
    t = F.col("candle_start_time")
    return hours.where(t >= full).unionByName(minutes.where((t >= start) & (t < full)))


def overview_from_states(hours: DataFrame, minutes: DataFrame, as_of=None, window: str = config.OVERVIEW_WINDOW) -> DataFrame:
    """``marts.market_overview`` of minute candles, from their states."""
    whole = partials.merge(window_parts(hours, minutes, as_of, window).withColumn("candle_start_time", F.lit(None).cast("timestamp")))
    return marts.overview_columns(whole.select(
        "symbol", F.col("last._o2").alias("_close"), F.date_trunc("minute", F.col("last._o0")).alias("_latest"),
        F.col("first._o2").alias("_open"), F.col("high_price").alias("high_24h"), F.col("low_price").alias("low_24h"),
        F.col("total_volume").alias("volume_24h"), F.col("buy_volume_taker").alias("buy_volume_24h"),
        F.col("sell_volume_maker").alias("sell_volume_24h"), F.col("trade_count").alias("total_trades_24h")))


def refresh_hours(hours: BucketTable, minutes: BucketTable) -> list[str]:
    """Bring the hourly states up to date with the minute states: the days
    whose data have changed since the commit that the hours know are replaced.
    Returns these days."""
    now = minutes.commit()
    known = minutes.commit(hours.commit().applied.get("minutes", 0))
    changed = [b for b, load in now.buckets.items() if known.buckets.get(b) != load]
    if changed:
        hours.merge(partials.coarser(minutes.rows(now, changed), "hour"), lambda old, new: new, ("minutes", now.number))
    return changed


def stored_overview(spark: SparkSession, hours: BucketTable, minutes: BucketTable, as_of: str | None = None,
                    window: str = config.OVERVIEW_WINDOW) -> DataFrame:
    """The overview at a clock ('YYYY-MM-DD HH:MM:SS', UTC; None: now), reading
    the window's days of the hourly states and one day of the minutes."""
    start = spark.range(1).select((as_ts(as_of) - F.expr(f"INTERVAL {window}")).alias("s")).select(
        F.date_format("s", "yyyy-MM-dd")).first()[0]
    held = hours.commit()
    return overview_from_states(hours.rows(held, [b for b in held.buckets if b >= start]),
                                minutes.rows(buckets=[start]), as_of, window)
