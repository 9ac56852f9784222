"""What a candle stream's checkpoint holds, through Spark's state data sources.

The open windows of a stopped (or running) stream, which it has not emitted
yet, are its state: read as mergeable states they give a view of all candles,
closed ones from the sink and open ones from the checkpoint, and show how much
a stream holds and how it is spread over its state partitions.

A checkpoint keeps its number of state partitions.  ``resume_point`` and
``move_candles`` carry a stream to a new checkpoint with another number: all
windows that begin before the resume point have been emitted, none after it, so
the new stream reads the stored trades from there on and builds the open
windows again (minutes of trades, whatever the history's size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from tickforge import config, schemas
from tickforge.operators import partials
from tickforge.streaming import sinks, stages

#: The aggregates' buffers in the order of the state's value.
_BUFFERS = ["first", "high_price", "low_price", "last", "total_volume", "buy_volume_taker", "sell_volume_maker", "trade_count"]


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row for each stateful operator: name, state partitions, batches."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "numPartitions", "minBatchId", "maxBatchId")


def _state(spark: SparkSession, checkpoint: str) -> DataFrame:
    fields = {f.name: f.dataType for f in schemas.PARTIAL_CANDLE.fields}
    value = StructType([StructField(c, fields[c]) for c in _BUFFERS])  # buffers have no names of their own
    return spark.read.format("statestore").load(checkpoint).select(
        F.col("key.window.start").alias("candle_start_time"), F.col("key.symbol").alias("symbol"),
        F.col("value").cast(value).alias("v"), "partition_id")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Mergeable states of the windows that a candle stream has not emitted."""
    return _state(spark, checkpoint).select("candle_start_time", "symbol", "v.*").select(*schemas.PARTIAL_CANDLE.fieldNames())


def spread(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Open windows, trades in them and their span for each state partition
    that has any."""
    return _state(spark, checkpoint).groupBy("partition_id").agg(
        F.count("*").alias("windows"), F.sum("v.trade_count").alias("trades"),
        F.min("candle_start_time").alias("earliest"), F.max("candle_start_time").alias("latest"))


def live_candles(emitted: DataFrame, checkpoint: str, ingested_at=None) -> DataFrame:
    """The stored candles and, after them, those of the open windows."""
    spark = emitted.sparkSession
    now = partials.candles_from(open_windows(spark, checkpoint), ingested_at)
    return emitted.select(*schemas.CANDLE_COLUMNS).unionByName(now)


def watermark(spark: SparkSession, checkpoint: str):
    """The watermark of the checkpoint's last committed batch (UTC, naive), up
    to which windows were emitted; None before the first commit."""
    root = checkpoint.rstrip("/")

    def lines(log):
        name = F.element_at(F.split(F.input_file_name(), "/"), -1)
        return spark.read.text(f"{root}/{log}").select(name.cast("long").alias("batch"), "value")

    done = lines("commits").agg(F.max("batch")).first()[0]
    if done is None:
        return None
    ms = F.get_json_object("value", "$.batchWatermarkMs").cast("long")
    return lines("offsets").where(F.col("batch") <= done) \
        .agg(F.timestamp_millis(F.max(ms)).cast("timestamp_ntz")).first()[0]


def resume_point(spark: SparkSession, checkpoint: str, width: str = config.CANDLE_WIDTH):
    """The start of the earliest window that the stream of this checkpoint has
    not closed (naive UTC text), None where it has closed none."""
    mark = watermark(spark, checkpoint)
    if mark is None:
        return None
    # a window is closed when the watermark has reached its end
    row = spark.range(1).select(F.lit(mark).cast("timestamp").alias("t")).groupBy(F.window("t", width).alias("w")) \
        .agg(F.first("t")).select(F.col("w.start").cast("string"))
    return row.first()[0]


def move_candles(spark: SparkSession, silver_path: str, gold_path: str, old: str, new: str, state_partitions: int,
                 width: str = config.CANDLE_WIDTH, trigger: str | None = "available_now", **kw) -> StreamingQuery:
    """Start the candle stream of the stopped checkpoint ``old`` again on the
    fresh checkpoint ``new`` with ``state_partitions``, into the same
    ``BatchFileSink`` folder.  Later restarts on ``new`` must give the same
    resume point, so call this for each of them while ``old`` is kept (it does
    not change any more)."""
    since = resume_point(spark, old, width)
    return stages.start_gold_batches(spark, silver_path, sinks.BatchFileSink(gold_path), new, trigger,
                                     width=width, state_partitions=state_partitions, since=since, **kw)
