"""Feeder side: raw exchange envelopes -> normalised trade messages -> keyed JSON.

A message that cannot be normalised (bad JSON, no ``data``, a missing
field, price or quantity that is not a number) is dropped, as the feeder
drops any message whose handling raises; the stream goes on.  A field is
missing when its key is: a JSON null in ``s``, ``T`` or ``m`` is kept as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge import config, schemas
from tickforge.functions import col_, iso_text


def normalize_envelopes(raw: DataFrame, text_col: str = "value",
                        ingested_at: Column | str | None = None,
                        keep_rejects: bool = False) -> DataFrame:
    """Parse raw envelope text into ``TRADE_MESSAGE`` rows.

    ``ingested_at``: ISO text column/literal for the ingestion clock;
    default is the current time.  With ``keep_rejects=True`` a boolean
    column ``_valid`` is kept instead of filtering, so callers can count
    rejected messages.
    """
    # Parse once into an attribute; extracting fields straight from the
    # from_json expression would re-parse the text for every field.
    parsed = raw.select(F.from_json(col_(text_col).cast("string"),
                                    schemas.RAW_ENVELOPE).getField("data").alias("_d"))
    d = F.col("_d")

    def field(name: str) -> Column:
        return F.try_element_at(d, F.lit(name))

    price = field("p").try_cast("double")
    qty = field("q").try_cast("double")
    if ingested_at is None:
        ing = iso_text(F.current_timestamp())
    elif isinstance(ingested_at, Column):
        ing = ingested_at
    else:
        ing = F.lit(ingested_at)
    valid = F.coalesce(price.isNotNull() & qty.isNotNull() & F.map_contains_key(d, "s")
                       & F.map_contains_key(d, "T") & F.map_contains_key(d, "m"), F.lit(False))
    fields = [
        F.lit(config.SOURCE_TAG).alias("source"),
        field("s").alias("symbol"),
        price.alias("price"),
        qty.alias("quantity"),
        field("T").try_cast("long").alias("trade_time"),
        field("m").try_cast("boolean").alias("is_buyer_maker"),
        ing.alias("ingested_at"),
        field("a").try_cast("long").alias("trade_id"),
    ]
    if keep_rejects:
        return parsed.select(*fields, valid.alias("_valid"))
    # Emit the row only when valid.  A generator instead of a filter: a
    # filter would be pushed below the parse and repeat from_json in its
    # condition once per field it tests.
    return parsed.select(F.inline(F.when(valid, F.array(F.struct(*fields)))))


def envelopes_from_trades(trades: DataFrame, stream_suffix: str = "@aggTrade") -> DataFrame:
    """Inverse of ``normalize_envelopes`` (for fixtures and replay):
    wrap trade messages as exchange envelopes with price/quantity as text."""
    data = F.struct(
        F.lit("aggTrade").alias("e"),
        F.col("trade_time").alias("E"),
        F.col("symbol").alias("s"),
        F.col("trade_id").alias("a"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.col("trade_time").alias("T"),
        F.col("is_buyer_maker").alias("m"),
    )
    stream = F.concat(F.lower(F.col("symbol")), F.lit(stream_suffix))
    return trades.select(F.to_json(F.struct(stream.alias("stream"), data.alias("data")),
                                   {"ignoreNullFields": "false"}).alias("value"))


def keyed_json(messages: DataFrame, key_col: str = "symbol") -> DataFrame:
    """(key, value) rows for a message bus: key = symbol, value = JSON of the row.

    NULL fields are written as JSON null, so every message carries every key.
    """
    cols = [F.col(c) for c in messages.columns]
    return messages.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"),
    )


def count_rejects(raw: DataFrame, text_col: str = "value") -> DataFrame:
    """Accepted and rejected message counts (one row), for monitoring."""
    flagged = normalize_envelopes(raw, text_col, ingested_at="", keep_rejects=True)
    return flagged.agg(F.count(F.when(F.col("_valid"), F.lit(1))).alias("accepted"),
                       F.count(F.when(~F.col("_valid"), F.lit(1))).alias("rejected"))
