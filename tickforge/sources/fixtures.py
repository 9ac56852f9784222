"""Trades and sentiment derived from the shared ``events`` test table.

The mapping is deterministic and uses only built-in expressions, so it is
a narrow (map-only) stage on top of the parquet scan and scales with the
table.  See FIXTURES.md for the rules; the numbers below are that
document's fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import config
from tickforge.functions import fng_classification
from tickforge.functions.exprs import ISO_FORMAT

# ---------------------------------------------------------------------------
# Fixed values of the fixture (FIXTURES.md §2, §3)
# ---------------------------------------------------------------------------
EVENT_SYMBOLS = {"purchase": "BTCUSDT", "click": "ETHUSDT", "view": "BNBUSDT",
                 "signup": "SOLUSDT", "error": "XRPUSDT"}
NULL_PRICE_EVERY = 101
CAPPED_PRICE_EVERY = 103
CAPPED_PRICE = 2_000_000.0
NEGATIVE_PRICE_EVERY = 107
ZERO_QUANTITY_EVERY = 109
NULL_SIDE_EVERY = 97
REDELIVER_EVERY = 10
BTC_PRICE_BASE = 1400.0
NANOSECOND_TIME_EVERY = 211
BIG_ID = 2**40
REPLAY_SOURCE = "replay"
LAST_INGEST = "9999-12-31T23:59:59.000000"
DAMAGE_EVERY = 13
GARBAGE_EVERY = 17
INGEST_LAG_SECONDS = 2
NO_SENTIMENT_DAY_EVERY = 7
FNG_MULTIPLIER = 37
FNG_MODULUS = 101
REVISED_DAY_EVERY = 3


# Declared schema of the shared ``events`` table (read without inference).
EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name == "events":
        r = r.schema(EVENTS_SCHEMA)
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame) -> DataFrame:
    """Normalised trade messages (see ``schemas.TRADE_MESSAGE``).

    One trade per event, and a second message for every tenth event, of four
    kinds in turn (FIXTURES.md §2): the same trade under an id 1024 higher;
    the same trade from another source, earlier and with the other side; the
    same trade ingested at the end of the year 9999 under a smaller id; and
    another trade of the same millisecond.  The rules are SQL expressions,
    one call each, and the copies are generated in the same pass, so the
    table is scanned once.
    """
    symbol = " ".join(f"WHEN '{etype}' THEN '{sym}'" for etype, sym in EVENT_SYMBOLS.items())
    price = (f"CAST(CASE WHEN event_id % {NULL_PRICE_EVERY} = 0 THEN NULL "
             f"WHEN event_id % {CAPPED_PRICE_EVERY} = 0 THEN {CAPPED_PRICE}D "
             f"WHEN event_id % {NEGATIVE_PRICE_EVERY} = 0 THEN -1.0D "
             f"ELSE floor(value * 64.0D) / 64.0D + CASE event_type WHEN 'purchase' THEN {BTC_PRICE_BASE}D "
             f"ELSE 0.0D END END + CASE _copy WHEN 3 THEN 0.015625D ELSE 0.0D END AS DOUBLE)")
    quantity = (f"CASE WHEN event_id % {ZERO_QUANTITY_EVERY} = 0 THEN 0.0D "
                f"ELSE (1 + user_id % 10) / 4.0D END")
    time = ("unix_millis(CAST(ts AS TIMESTAMP)) * "
            f"CASE WHEN event_id % {NANOSECOND_TIME_EVERY} = 0 THEN 1000000 ELSE 1 END")
    side = (f"CASE WHEN event_id % {NULL_SIDE_EVERY} = 0 THEN NULL "
            f"ELSE (event_id % 2 = 0) = (_copy <> 1) END")
    ingested = (f"CASE _copy WHEN 2 THEN '{LAST_INGEST}' ELSE date_format(CAST(ts AS TIMESTAMP) + "
                f"make_dt_interval(0, 0, 0, CASE _copy WHEN 1 THEN 1 ELSE {INGEST_LAG_SECONDS} END), "
                f"\"{ISO_FORMAT}\") END")
    trade_id = (f"CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN event_id + {BIG_ID} ELSE event_id END "
                "+ CASE _copy WHEN 0 THEN 1024 WHEN 2 THEN -1 WHEN 3 THEN 1 ELSE 0 END")
    copies = (f"explode(CASE WHEN event_id % {REDELIVER_EVERY} = 0 "
              f"THEN array(-1L, event_id div {REDELIVER_EVERY} % 4) ELSE array(-1L) END)")
    return events.select("*", F.expr(copies).alias("_copy")).select(
        F.expr(f"CASE _copy WHEN 1 THEN '{REPLAY_SOURCE}' ELSE '{config.SOURCE_TAG}' END").alias("source"),
        F.expr(f"CASE event_type {symbol} END").alias("symbol"),
        F.expr(price).alias("price"),
        F.expr(quantity).alias("quantity"),
        F.expr(time).alias("trade_time"),
        F.expr(side).alias("is_buyer_maker"),
        F.expr(ingested).alias("ingested_at"),
        F.expr(trade_id).alias("trade_id"),
    )


def damaged(envelopes: DataFrame) -> DataFrame:
    """Envelopes (column ``value``) as a feed may send them: by trade time
    modulo 13, some lack the side's key, some are cut off, and some have a
    JSON null for the time."""
    t = F.regexp_extract("value", '"T":([0-9]+)', 1).cast("long") % DAMAGE_EVERY
    v = F.col("value")
    return envelopes.select(
        F.when(t == 0, F.regexp_replace(v, ',"m":[a-z]+', "")).when(t == 1, F.substring(v, 1, 40))
        .when(t == 2, F.regexp_replace(v, '"T":[0-9]+', '"T":null')).otherwise(v).alias("value"))


def with_garbage(messages: DataFrame) -> DataFrame:
    """Keyed messages, some (by hash) followed by one that is no JSON."""
    both = F.array(F.struct("key", "value"), F.struct("key", F.lit("{not json").alias("value")))
    some = F.crc32(F.col("value")) % GARBAGE_EVERY == 0
    return messages.select(F.inline(F.when(some, both).otherwise(F.slice(both, 1, 1))))


def event_days(events: DataFrame) -> DataFrame:
    """Distinct calendar days of the events (a small aggregate)."""
    return events.select(F.to_date(F.col("ts").cast("timestamp")).alias("date")).distinct()


def _fng(day: Column) -> Column:
    return (day * F.lit(FNG_MULTIPLIER)) % F.lit(FNG_MODULUS)


def _sentiment_readings(events: DataFrame, stored_at, revised_at) -> DataFrame:
    """Per event day, its stored reading and its revised one (value + 1),
    generated together from the distinct days.  Days with day%7=0 have no
    reading; only days with day%3=0 are revised.  The day filters apply to
    generated rows, so every branch built on this shares one aggregate of
    the table (Spark reuses its exchange) instead of scanning it again."""
    d = F.col("date")
    v = _fng(F.dayofmonth(d)).cast("int")
    rv = (v + 1).cast("int")

    def reading(kind, value, at):
        return F.struct(F.lit(kind).alias("kind"), d.alias("date"), value.alias("fng_value"),
                        fng_classification(value).alias("fng_classification"),
                        F.lit(at).cast("timestamp").alias("updated_at"))

    rows = event_days(events).select(
        F.inline(F.array(reading("stored", v, stored_at), reading("revised", rv, revised_at))))
    day = F.dayofmonth("date")
    keep = (day % NO_SENTIMENT_DAY_EVERY != 0) & (
        (F.col("kind") == "stored") | (day % REVISED_DAY_EVERY == 0))
    return rows.filter(keep)


def sentiment_rows(events: DataFrame, updated_at) -> DataFrame:
    """Stored sentiment rows: one per event day, days with day%7=0 missing."""
    return (_sentiment_readings(events, updated_at, None).filter(F.col("kind") == "stored")
            .drop("kind"))


def sentiment_documents(events: DataFrame) -> DataFrame:
    """API-style JSON documents (column ``value``), one per sentiment day.

    Each document wraps one reading as the API does: value and timestamp
    (epoch seconds at midnight UTC) are text.
    """
    rows = sentiment_rows(events, None)
    reading = F.struct(
        F.col("fng_value").cast("string").alias("value"),
        F.col("fng_classification").alias("value_classification"),
        F.unix_timestamp(F.col("date").cast("timestamp")).cast("string").alias("timestamp"),
    )
    return rows.select(F.to_json(F.struct(
        F.array(reading).alias("data"),
        F.struct(F.lit(None).cast("string").alias("error")).alias("metadata"),
    )).alias("value"))


def sentiment_revisions(events: DataFrame, updated_at) -> DataFrame:
    """Incoming upsert batch: revised readings for days with day%3=0
    (value + 1) plus a reading for the day after the last event day."""
    revised = (_sentiment_readings(events, None, updated_at)
               .filter(F.col("kind") == "revised").drop("kind"))
    nxt = event_days(events).agg(F.date_add(F.max("date"), 1).alias("date"))
    new_v = _fng(F.dayofmonth("date")).cast("int")
    extra = nxt.select("date", new_v.alias("fng_value"),
                       fng_classification(new_v).alias("fng_classification"),
                       F.lit(updated_at).cast("timestamp").alias("updated_at"))
    return revised.unionByName(extra)


def faulty_candles(candles: DataFrame) -> DataFrame:
    """Candles with planted faults, by the minute m of the epoch they start in:
    twice (m % 101 = 0), without a symbol (103), their high below their low
    (107), without trades (109), without an open price (113)."""
    m = F.floor(F.unix_seconds("candle_start_time") / 60)
    copies = F.when(m % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return candles.withColumns({
        "_copy": F.explode(copies),
        "symbol": F.when(m % 103 != 0, F.col("symbol")),
        "high_price": F.when(m % 107 == 0, F.col("low_price") - 1).otherwise(F.col("high_price")),
        "trade_count": F.when(m % 109 == 0, F.lit(0).cast("long")).otherwise(F.col("trade_count")),
        "open_price": F.when(m % 113 != 0, F.col("open_price")),
    }).drop("_copy")
