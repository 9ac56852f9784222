"""Reusable column expressions.

Each helper returns a ``Column`` built only from ``pyspark.sql.functions``
so it stays inside whole-stage code generation; nothing here runs Python
per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickforge import config

__all__ = [
    "col_", "ts_from_millis", "ts_from_text", "minutes_between", "pct",
    "date_from_epoch_seconds", "trade_value", "trade_side", "price_magnitude",
    "is_large_trade", "candle_type", "freshness_status", "fng_classification",
    "iso_text", "as_ts", "in_millis_range", "order_fields",
]

# Epoch milliseconds of 0001-01-01 and of the end of 9999-12-31.
FIRST_MILLIS = -62_135_596_800_000
LAST_MILLIS = 253_402_300_799_999


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ts(value) -> Column:
    """A timestamp literal (string 'yyyy-MM-dd HH:mm:ss'), a Column, or
    None for the current time (the query's start time)."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def in_millis_range(ms) -> Column:
    """Whether epoch milliseconds fall in the years 1 to 9999 (NULL for NULL)."""
    return col_(ms).between(FIRST_MILLIS, LAST_MILLIS)


def ts_from_millis(ms) -> Column:
    """Epoch milliseconds -> timestamp, exact to the millisecond; NULL for a
    value outside the years 1 to 9999 (nanoseconds sent by mistake, say), so
    that no message can stop a job."""
    return F.timestamp_millis(F.when(in_millis_range(ms), col_(ms)))


def ts_from_text(text) -> Column:
    """ISO-8601 text -> timestamp; malformed text gives NULL, not an error."""
    return col_(text).try_cast("timestamp")


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_text(ts) -> Column:
    """Timestamp -> ISO-8601 text with microseconds (no zone)."""
    return F.date_format(col_(ts), ISO_FORMAT)


def minutes_between(later, earlier) -> Column:
    """(later - earlier) in fractional minutes."""
    return (F.unix_micros(col_(later)) - F.unix_micros(col_(earlier))) / F.lit(60_000_000.0)


def pct(num, den, scale: int) -> Column:
    """round(num / nullif(den, 0) * 100, scale); NULL when den is 0."""
    den_c = col_(den)
    return F.round(col_(num) / F.nullif(den_c, F.lit(0)) * F.lit(100.0), scale)


def date_from_epoch_seconds(text_or_num) -> Column:
    """Epoch seconds (text or number) -> calendar date in the session zone;
    NULL for text that is no number and outside the years 1 to 9999."""
    secs = col_(text_or_num).try_cast("long")
    ok = secs.between(FIRST_MILLIS // 1000, LAST_MILLIS // 1000)
    return F.to_date(F.timestamp_seconds(F.when(ok, secs)))


def trade_value(price="price", quantity="quantity") -> Column:
    return F.round(col_(price) * col_(quantity), config.PRICE_SCALE)


def trade_side(is_buyer_maker="is_buyer_maker") -> Column:
    """BUY when the buyer is the taker; SELL otherwise, NULL side included."""
    return F.when(col_(is_buyer_maker) == F.lit(False), F.lit("BUY")).otherwise(F.lit("SELL"))


def price_magnitude(price="price") -> Column:
    return F.round(F.ln(col_(price)) / F.ln(F.lit(10.0)), config.MAGNITUDE_SCALE)


def is_large_trade(value="trade_value") -> Column:
    return F.when(col_(value) > F.lit(config.LARGE_TRADE_VALUE), F.lit(True)).otherwise(F.lit(False))


def candle_type(open_="open_price", close="close_price") -> Column:
    return F.when(col_(close) >= col_(open_), F.lit("Bullish")).otherwise(F.lit("Bearish"))


def freshness_status(minutes, fresh: float = config.FRESH_MINUTES,
                     stale: float = config.STALE_MINUTES) -> Column:
    m = col_(minutes)
    return (F.when(m <= F.lit(fresh), F.lit("Fresh"))
             .when(m <= F.lit(stale), F.lit("Stale"))
             .otherwise(F.lit("Dead")))


def fng_classification(value) -> Column:
    """Fear & Greed label from the index value (fixture thresholds)."""
    v = col_(value)
    expr = None
    for bound, label in config.FNG_CLASSES[:-1]:
        expr = (F.when(v <= F.lit(bound), F.lit(label)) if expr is None
                else expr.when(v <= F.lit(bound), F.lit(label)))
    return expr.otherwise(F.lit(config.FNG_CLASSES[-1][1]))


def order_fields(*cols) -> list[Column]:
    """Fields that put rows in ascending order with NULLs last, for the front
    of a struct under ``min`` or ``max``: each column behind its null flag.
    The whole values are compared, whatever their size."""
    out = []
    for i, c in enumerate(cols):
        out += [col_(c).isNull().alias(f"_n{i}"), col_(c).alias(f"_o{i}")]
    return out
