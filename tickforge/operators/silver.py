"""Silver: quality filter, normalisation, enrichment and de-duplication.

``clean`` + ``normalize`` + ``enrich`` are narrow (per-row) operators that
fuse into one code-generated stage after the scan; the quality predicate
is pushed into the parquet reader when the input is a table.  The batch
de-duplication is an aggregate, so duplicate copies are combined on the
map side before the shuffle and a hot key never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge import config
from tickforge.functions import (col_, in_millis_range, is_large_trade, order_fields,
                                 price_magnitude, trade_side, trade_value, ts_from_millis,
                                 ts_from_text)


def quality_predicate(strict: bool = False) -> Column:
    """price in (0, cap), quantity > 0, symbol and trade_time present, and
    trade_time a time of the years 1 to 9999.

    As upstream, a NaN price fails ``< cap`` while a NaN or infinite
    quantity passes ``> 0``; ``strict=True`` also rejects those.
    """
    p, q = F.col("price"), F.col("quantity")
    pred = (p.isNotNull() & (p > 0) & q.isNotNull() & (q > 0)
            & F.col("symbol").isNotNull() & F.col("trade_time").isNotNull()
            & in_millis_range("trade_time") & (p < F.lit(config.PRICE_CAP)))
    if strict:
        pred = pred & ~F.isnan(q) & (q < F.lit(float("inf")))
    return pred


def clean(trades: DataFrame, strict: bool = False) -> DataFrame:
    return trades.filter(quality_predicate(strict))


def normalize(trades: DataFrame) -> DataFrame:
    """Timestamps from epoch ms / ISO text, 8-digit price and quantity,
    bronze-only columns dropped."""
    drop = [c for c in ("trade_time", "ingested_at", "timestamp", "year", "month",
                        "day", "hour") if c in trades.columns]
    out = trades.withColumns({
        "trade_timestamp": ts_from_millis("trade_time"),
        "ingest_timestamp": ts_from_text("ingested_at"),
        "price": F.round("price", config.PRICE_SCALE),
        "quantity": F.round("quantity", config.PRICE_SCALE),
    })
    if "trade_id" not in out.columns:
        out = out.withColumn("trade_id", F.lit(None).cast("long"))
    return out.drop(*drop)


def enrich(trades: DataFrame, processed_at: Column | str | None = None) -> DataFrame:
    """trade_value, trade_side, price_magnitude, is_large_trade, processed_at.

    ``processed_at`` defaults to the current (micro-batch) time; pass a
    literal to make a run reproducible.
    """
    if processed_at is None:
        proc = F.current_timestamp()
    elif isinstance(processed_at, Column):
        proc = processed_at
    else:
        proc = F.lit(processed_at).cast("timestamp")
    out = trades.withColumn("trade_value", trade_value())
    return out.withColumns({
        "trade_side": trade_side(),
        "price_magnitude": price_magnitude(),
        "is_large_trade": is_large_trade("trade_value"),
        "processed_at": proc,
    })


def add_date_parts(trades: DataFrame, ts_col: str = "trade_timestamp") -> DataFrame:
    ts = col_(ts_col)
    return trades.withColumns({"year": F.year(ts), "month": F.month(ts),
                               "day": F.dayofmonth(ts)})


SILVER_ORDER = ["source", "symbol", "price", "quantity", "is_buyer_maker", "trade_id",
                "trade_timestamp", "ingest_timestamp", "trade_value", "trade_side",
                "price_magnitude", "is_large_trade", "processed_at"]


def transform(trades: DataFrame, processed_at=None, strict: bool = False) -> DataFrame:
    """clean -> normalize -> enrich (no de-duplication, no partitions)."""
    return enrich(normalize(clean(trades, strict)), processed_at).select(*SILVER_ORDER)


def dedupe(trades: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Batch de-duplication: one row per key, the first arrival.

    "First" is the earliest ingest time (rows without one come last), then
    the smallest trade id (none comes last), then the remaining columns in
    name order, so the kept row is the same whatever the input order.  It is
    the ``min`` of one struct: the whole values are compared, and copies are
    combined on the map side before the shuffle, so a key delivered millions
    of times costs one row per map task.  Apply it before ``enrich``:
    enrichment is per row, so the result is the same and the aggregate
    carries fewer columns.
    """
    key = list(key or config.DEDUPE_KEY)
    rest = [c for c in trades.columns if c not in key]
    lead = [c for c in ("ingest_timestamp", "trade_id") if c in rest]
    tail = sorted(c for c in rest if c not in lead)
    first = F.min(F.struct(*order_fields(*lead, *tail)))
    place = {c: f"_first._o{i}" for i, c in enumerate([*lead, *tail])}
    return (trades.groupBy(*key).agg(first.alias("_first"))
            .select(*[F.col(place.get(c, c)).alias(c) for c in trades.columns]))


def dedupe_stream(trades: DataFrame, key: list[str] | None = None,
                  delay: str = config.WATERMARK_DELAY) -> DataFrame:
    """Streaming de-duplication: watermark on trade time, keep first arrival.

    The key contains the event time, so state for a key is evicted once the
    watermark passes it; rows behind the watermark are dropped.
    """
    key = key or config.DEDUPE_KEY
    return trades.withWatermark("trade_timestamp", delay).dropDuplicates(key)


def silver_batch(trades: DataFrame, processed_at=None, strict: bool = False) -> DataFrame:
    """Full silver table in batch: clean, normalise, de-duplicate, enrich,
    partition columns (one shuffle: the de-duplication aggregate)."""
    deduped = dedupe(normalize(clean(trades, strict)))
    return add_date_parts(enrich(deduped, processed_at).select(*SILVER_ORDER))


def silver_stream(trades: DataFrame, processed_at=None, strict: bool = False,
                  delay: str = config.WATERMARK_DELAY, first_seen: bool = True) -> DataFrame:
    """Same as ``silver_batch`` for a streaming input.

    ``first_seen=True`` (upstream's behaviour) keeps the first copy the
    stream sees with ``dropDuplicates`` and emits it at once.  With
    ``first_seen=False`` the de-duplication is the batch aggregate on a
    watermarked stream.  Each micro-batch then combines copies on the map
    side before the state shuffle, so a key delivered millions of times
    costs one row per task, and the kept copy is the first arrival
    (earliest ingest time, then trade id), equal to ``silver_batch``.  A key
    is emitted once the watermark passes its trade time, ``delay`` later
    than with ``dropDuplicates``.
    """
    if first_seen:
        return add_date_parts(dedupe_stream(transform(trades, processed_at, strict), delay=delay))
    normed = normalize(clean(trades, strict)).withWatermark("trade_timestamp", delay)
    return add_date_parts(enrich(dedupe(normed), processed_at).select(*SILVER_ORDER))
