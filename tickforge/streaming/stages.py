"""Streaming stages: bronze, silver and gold as Structured Streaming queries.

Each stage reads a stream, applies the shared DataFrame operators and
writes with a checkpoint, so a restarted run continues where the last
committed micro-batch ended.  ``trigger='available_now'`` drains the
backlog (possibly in several micro-batches) and stops, which is how the
hourly runs use it; the no-data batch at the end lets the watermark
close every window it has passed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickforge import config, schemas
from tickforge.operators import bronze, candles, partials, silver
from tickforge.session import library_session, require_utc
from tickforge.sources.streams import lake_stream
from tickforge.streaming.deadletters import SplitSink
from tickforge.streaming.incremental import HourSink
from tickforge.streaming.sinks import BatchFileSink, clustered

# Name of the bronze stream's counters in its progress reports.
BRONZE_COUNTS = "bronze_quality"


def stage_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """The session a stage's stream is built in: the library's settings, and
    ``state_partitions`` state-store partitions for its stateful operators.

    Spark takes that number from ``spark.sql.shuffle.partitions`` when a
    query first starts and keeps it in the checkpoint afterwards.  The
    session is the stage's own, so neither the caller's nor that of a stage
    started at the same time changes.
    """
    own = library_session(spark, new=bool(state_partitions))
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def _trigger(writer, trigger: str | None):
    if trigger in (None, "available_now"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def await_done(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until a run-once query finishes; re-raise its failure."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def start_bronze(messages: DataFrame, path: str, checkpoint: str,
                 trigger: str | None = "available_now", name: str | None = None,
                 files_per_partition: int | None = None) -> StreamingQuery:
    """Message stream -> bronze parquet partitioned by year/month/day/hour.

    Messages that cannot be decoded or have an impossible time are kept as
    NULLs and counted: ``ProgressTotals`` sums the counters.
    """
    require_utc(messages.sparkSession)   # partition parts are UTC calendar fields
    out = bronze.bronze_from_messages(messages).select(*[f.name for f in schemas.BRONZE.fields])
    out = out.observe(BRONZE_COUNTS, *bronze.quality_counts())
    out = clustered(out, schemas.BRONZE_PARTITIONS, files_per_partition, ["symbol", "trade_time", "price"])
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy(*schemas.BRONZE_PARTITIONS))
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def start_bronze_hours(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "available_now",
                       files_per_partition: int | None = None) -> StreamingQuery:
    """Message stream -> bronze hour folders with a manifest for each batch
    (``streaming.incremental``), for loads that take what is new by manifest."""
    require_utc(messages.sparkSession)
    out = bronze.bronze_from_messages(messages).select(*[f.name for f in schemas.BRONZE.fields])
    out = clustered(out, schemas.BRONZE_PARTITIONS, files_per_partition, ["symbol", "trade_time", "price"],
                    out.sparkSession.sparkContext.defaultParallelism)
    w = (out.writeStream.outputMode("append").foreachBatch(HourSink(path, checkpoint))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_split(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "available_now",
                delay: str = config.WATERMARK_DELAY, files_per_partition: int | None = None) -> StreamingQuery:
    """Message stream -> accepted rows and dead letters
    (``streaming.deadletters``)."""
    require_utc(messages.sparkSession)
    w = (messages.writeStream.outputMode("append")
         .foreachBatch(SplitSink(path, checkpoint, delay, files_per_partition))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_silver(spark: SparkSession, bronze_path: str, path: str, checkpoint: str,
                 trigger: str | None = "available_now", processed_at=None,
                 delay: str = config.WATERMARK_DELAY, strict: bool = False,
                 state_partitions: int | None = None, first_seen: bool = True,
                 files_per_partition: int | None = None) -> StreamingQuery:
    """Bronze lake stream -> cleaned, enriched, de-duplicated silver lake
    (``first_seen``: see ``silver.silver_stream``).

    A run takes its whole backlog as one micro-batch: bounding it would move
    the watermark between files that are not in time order and so drop rows.
    """
    src = lake_stream(stage_session(spark, state_partitions), bronze_path, schemas.BRONZE)
    out = silver.silver_stream(src, processed_at, strict, delay, first_seen).select(
        *[f.name for f in schemas.SILVER.fields])
    out = clustered(out, schemas.SILVER_PARTITIONS, files_per_partition, ["symbol", "trade_timestamp", "price"])
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy(*schemas.SILVER_PARTITIONS))
    return _trigger(w, trigger).start()


def gold_candles(spark: SparkSession, silver_path: str, width: str = config.CANDLE_WIDTH,
                 delay: str = config.WATERMARK_DELAY, ingested_at=None,
                 state_partitions: int | None = None, since=None) -> DataFrame:
    """The candle stream; ``since`` (``state.resume_point``) lets a stream on
    a new checkpoint begin where another one has emitted everything before.
    Days before it are pruned by their folders."""
    src = lake_stream(stage_session(spark, state_partitions), silver_path, schemas.SILVER)
    if since is not None:
        at = F.lit(since).cast("timestamp")
        src = src.where((F.make_date("year", "month", "day") >= F.to_date(at)) & (F.col("trade_timestamp") >= at))
    return candles.candles_stream(src, width, delay, ingested_at)


def start_gold_files(spark: SparkSession, silver_path: str, path: str, checkpoint: str,
                     trigger: str | None = "available_now", **kw) -> StreamingQuery:
    """Candle stream -> parquet file sink (append; the sink's commit log
    makes it exactly-once)."""
    w = (gold_candles(spark, silver_path, **kw).writeStream.format("parquet")
         .outputMode("append").option("path", path).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_gold_batches(spark: SparkSession, silver_path: str, sink, checkpoint: str,
                       trigger: str | None = "available_now", **kw) -> StreamingQuery:
    """Candle stream -> a ``foreachBatch`` sink (``BatchFileSink``, given as
    such or by its folder, or ``JdbcSink``)."""
    if isinstance(sink, str):
        sink = BatchFileSink(sink)
    if isinstance(sink, BatchFileSink):
        sink = sink.bound(checkpoint)
    w = (gold_candles(spark, silver_path, **kw).writeStream.outputMode("append")
         .foreachBatch(sink).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_partials(spark: SparkSession, silver_path: str, path: str, checkpoint: str,
                   trigger: str | None = "available_now", width: str = config.CANDLE_WIDTH) -> StreamingQuery:
    """Silver stream -> mergeable candle states (``operators.partials``).

    There is no state in the stream and no watermark: each micro-batch is
    aggregated by itself and merged into the stored days that it has trades
    of, however late.  The sink's name for the stream is its checkpoint, so a
    replayed batch is applied once."""
    src = lake_stream(stage_session(spark), silver_path, schemas.SILVER)
    w = (src.writeStream.outputMode("append").foreachBatch(partials.PartialCandleSink(path, checkpoint, width))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


class ProgressTotals(StreamingQueryListener):
    """Totals over all progress reports of a session's streams, by query id:
    rows dropped as late, and the bronze stream's counters.  (A query itself
    keeps its most recent reports only.)  Register it with
    ``stage_session(spark).streams.addListener`` before the start."""

    def __init__(self):
        self.late: dict[str, int] = {}
        self.counts: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        key = str(p.id)
        self.late[key] = self.late.get(key, 0) + sum(int(x.numRowsDroppedByWatermark or 0) for x in p.stateOperators)
        seen = (p.observedMetrics or {}).get(BRONZE_COUNTS)
        if seen is not None:
            own = self.counts.setdefault(key, {})
            for k, v in seen.asDict().items():
                own[k] = own.get(k, 0) + int(v or 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
