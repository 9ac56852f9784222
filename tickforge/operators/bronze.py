"""Bronze: message-bus rows -> typed trades with event-time partition parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.functions import ts_from_millis


def decode_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` (binary or text JSON) -> the trade-message columns.

    Malformed JSON yields an all-NULL row, which bronze keeps (it lands in
    the default partition) and silver's quality filter removes.  A time out
    of range gives NULL time parts, never an error.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), schemas.TRADE_MESSAGE)
    # inline() expands the struct in a generator: one parse per message even
    # when later filters on these columns are pushed towards the source.
    return raw.select(F.inline(F.array(parsed)))


def add_time_parts(trades: DataFrame) -> DataFrame:
    """Event timestamp plus year/month/day/hour partition columns."""
    ts = ts_from_millis("trade_time")
    return trades.withColumns({
        "timestamp": ts,
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    })


def bronze_from_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    return add_time_parts(decode_messages(raw, value_col))


def quality_counts() -> list:
    """Counters for ``observe`` on bronze rows: all of them, messages that
    could not be decoded, and trade times out of range."""
    none = F.col("symbol").isNull() & F.col("trade_time").isNull()
    odd = F.col("trade_time").isNotNull() & F.col("timestamp").isNull()
    return [F.count(F.lit(1)).alias("rows"), F.count(F.when(none, F.lit(1))).alias("unparsed"),
            F.count(F.when(odd, F.lit(1))).alias("time_out_of_range")]


def count_unparsed(bronze_rows: DataFrame) -> DataFrame:
    """The same counters of a bronze table, as one row."""
    return bronze_rows.agg(*quality_counts())
