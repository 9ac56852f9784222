"""Declared schemas.

Jobs read with fixed schemas instead of inferring them, so a stream
can start on an empty folder and a bad file cannot change column types.
``trade_id`` is an optional exchange trade id (the aggregate-trade id of
the raw message); it is only used to order trades that share a
millisecond and is NULL when the producer does not send it.
"""

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType,
                               LongType, MapType, StringType, StructField, StructType,
                               TimestampType, ArrayType)

# Normalised trade message, as published on the message bus (JSON text).
TRADE_MESSAGE = StructType([
    StructField("source", StringType()),
    StructField("symbol", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", DoubleType()),
    StructField("trade_time", LongType()),          # epoch milliseconds
    StructField("is_buyer_maker", BooleanType()),
    StructField("ingested_at", StringType()),       # ISO-8601 text
    StructField("trade_id", LongType()),
])

# Raw exchange envelope: {"stream": ..., "data": {s, p, q, T, m, a, ...}}.
# The payload is read as a map of JSON texts, which tells a key that is
# missing from one that is null, and takes a number or a text alike.
RAW_ENVELOPE = StructType([
    StructField("stream", StringType()),
    StructField("data", MapType(StringType(), StringType())),
])

BRONZE_PARTITIONS = ["year", "month", "day", "hour"]
BRONZE = StructType(TRADE_MESSAGE.fields + [
    StructField("timestamp", TimestampType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("hour", IntegerType()),
])

SILVER_PARTITIONS = ["year", "month", "day"]
SILVER = StructType([
    StructField("source", StringType()),
    StructField("symbol", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", DoubleType()),
    StructField("is_buyer_maker", BooleanType()),
    StructField("trade_id", LongType()),
    StructField("trade_timestamp", TimestampType()),
    StructField("ingest_timestamp", TimestampType()),
    StructField("trade_value", DoubleType()),
    StructField("trade_side", StringType()),
    StructField("price_magnitude", DoubleType()),
    StructField("is_large_trade", BooleanType()),
    StructField("processed_at", TimestampType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
])

CANDLE = StructType([
    StructField("candle_start_time", TimestampType()),
    StructField("symbol", StringType()),
    StructField("open_price", DoubleType()),
    StructField("high_price", DoubleType()),
    StructField("low_price", DoubleType()),
    StructField("close_price", DoubleType()),
    StructField("total_volume", DoubleType()),
    StructField("buy_volume_taker", DoubleType()),
    StructField("sell_volume_maker", DoubleType()),
    StructField("trade_count", LongType()),
    StructField("ingested_at", TimestampType()),
])
# A mergeable candle: first and last trade as structs under ``order_fields``
# (time, id, price, each behind its null flag), extremes, sums and count.
ORDERED_TRADE = StructType([
    StructField("_n0", BooleanType()), StructField("_o0", TimestampType()),
    StructField("_n1", BooleanType()), StructField("_o1", LongType()),
    StructField("_n2", BooleanType()), StructField("_o2", DoubleType()),
])
PARTIAL_CANDLE = StructType([
    StructField("candle_start_time", TimestampType()),
    StructField("symbol", StringType()),
    StructField("first", ORDERED_TRADE),
    StructField("last", ORDERED_TRADE),
    StructField("high_price", DoubleType()),
    StructField("low_price", DoubleType()),
    StructField("total_volume", DoubleType()),
    StructField("buy_volume_taker", DoubleType()),
    StructField("sell_volume_maker", DoubleType()),
    StructField("trade_count", LongType()),
])
CANDLE_COLUMNS = [f.name for f in CANDLE.fields]

# Fear & Greed API document: {"data": [{"value", "value_classification",
# "timestamp" (epoch seconds, as text)}], ...}
SENTIMENT_DOC = StructType([
    StructField("data", ArrayType(StructType([
        StructField("value", StringType()),
        StructField("value_classification", StringType()),
        StructField("timestamp", StringType()),
    ]))),
])

SENTIMENT = StructType([
    StructField("date", DateType()),
    StructField("fng_value", IntegerType()),
    StructField("fng_classification", StringType()),
    StructField("updated_at", TimestampType()),
])

HISTORY_COLUMNS = ["symbol", "price", "quantity", "is_buyer_maker",
                   "trade_timestamp", "ingest_timestamp"]
