"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the shared test tables (trades and sentiment are
derived from ``events``), so its work grows with the table.  Clocks that
upstream reads from ``NOW()`` are fixed here so results are comparable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import bronze, candles, checks, envelope, history, marts, partials, sentiment, silver
from tickforge.plans import contracts, medallion
from tickforge.plans.oracle import FRESH_CLOCK, ROLLING_CLOCKS, RUN_CLOCK
from tickforge.session import library_session, run_dir
from tickforge.sources import fixtures
from tickforge.sources.ordered import with_position
from tickforge.sources.streams import lake_table, landed_documents, message_files
from tickforge.streaming import deadletters, incremental, stages, state
from tickforge.streaming.sinks import BatchFileSink

NEXT_LOAD_CLOCK = "2024-01-31 01:00:00"
# The restarted streams: their first run has the trades before this day, less
# those whose millisecond is a multiple of LATE_EVERY, which come later.
RESTART_DAY = "2024-01-20"
LATE_EVERY = 50


def _in_own_session(query):
    """Run a registered query in a session with the library's settings."""
    return lambda spark, sf_dir: query(library_session(spark), sf_dir)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load_table(spark, sf_dir, "events")


def _trades(spark, sf_dir):
    return fixtures.trades_from_events(_events(spark, sf_dir))


def _silver(spark, sf_dir):
    return silver.silver_batch(_trades(spark, sf_dir), processed_at=RUN_CLOCK)


def _candles(spark, sf_dir, width="1 minute"):
    return candles.candles(_silver(spark, sf_dir), width, ingested_at=RUN_CLOCK)


def _sentiment(spark, sf_dir):
    return fixtures.sentiment_rows(_events(spark, sf_dir), RUN_CLOCK)


def q_fx_trades(spark, sf_dir):
    return _trades(spark, sf_dir)


def q_silver_clean(spark, sf_dir):
    return silver.clean(_trades(spark, sf_dir))


def q_silver_enriched(spark, sf_dir):
    return silver.transform(_trades(spark, sf_dir), processed_at=RUN_CLOCK)


def q_silver_dedup(spark, sf_dir):
    return _silver(spark, sf_dir)


def q_candles_1m(spark, sf_dir):
    return _candles(spark, sf_dir)


def q_candles_1h(spark, sf_dir):
    return _candles(spark, sf_dir, "1 hour")


def q_market_overview(spark, sf_dir):
    return marts.market_overview(_candles(spark, sf_dir), RUN_CLOCK)


def q_market_overview_fresh(spark, sf_dir):
    return marts.market_overview(_candles(spark, sf_dir), FRESH_CLOCK)


def q_ohlc_summary(spark, sf_dir):
    return marts.ohlc_summary(_candles(spark, sf_dir))


def q_pipeline_health(spark, sf_dir):
    return _health(spark, sf_dir, FRESH_CLOCK)


def q_pipeline_health_run(spark, sf_dir):
    return _health(spark, sf_dir, RUN_CLOCK)


def _health(spark, sf_dir, clock):
    """The hourly table is written, then aggregated by symbol and by day."""
    path = f"{run_dir(spark, 'hourly')}/hourly"
    candles_df = _candles(spark, sf_dir)
    marts.hourly_ingestion(candles_df).write.parquet(path)
    return marts.pipeline_health(candles_df, clock, hourly=lake_table(spark, path))


def q_sentiment_parsed(spark, sf_dir):
    """API documents landed as JSON lines, read back and parsed."""
    path = f"{run_dir(spark, 'sentiment-docs')}/docs"
    fixtures.sentiment_documents(_events(spark, sf_dir)).write.text(path)
    return sentiment.parse_documents(landed_documents(spark, path), updated_at=RUN_CLOCK)


def q_sentiment_upsert(spark, sf_dir):
    """The stored dimension and the incoming batch are tables, as in a
    daily load: both are written first, then the upsert reads the two."""
    ev = _events(spark, sf_dir)
    root = run_dir(spark, "sentiment")
    fixtures.sentiment_rows(ev, RUN_CLOCK).write.parquet(f"{root}/stored")
    fixtures.sentiment_revisions(ev, NEXT_LOAD_CLOCK).write.parquet(f"{root}/incoming")
    return sentiment.upsert_latest(lake_table(spark, f"{root}/stored"),
                                   lake_table(spark, f"{root}/incoming"))


def q_price_vs_sentiment(spark, sf_dir):
    return marts.price_vs_sentiment(_candles(spark, sf_dir), _sentiment(spark, sf_dir))


def q_envelope_normalized(spark, sf_dir):
    raw = fixtures.damaged(envelope.envelopes_from_trades(_trades(spark, sf_dir)))
    return envelope.normalize_envelopes(raw, ingested_at=RUN_CLOCK.replace(" ", "T") + ".000000")


def q_keyed_json(spark, sf_dir):
    return envelope.keyed_json(_trades(spark, sf_dir))


def q_bronze_trades(spark, sf_dir):
    return bronze.bronze_from_messages(envelope.keyed_json(_trades(spark, sf_dir)))


def q_history_load(spark, sf_dir):
    """Silver lake -> history table (per-day overwrite), read back."""
    lake = run_dir(spark, "history")
    medallion.write_silver(_trades(spark, sf_dir), f"{lake}/silver", processed_at=RUN_CLOCK)
    history.write_history(history.history_rows(lake_table(spark, f"{lake}/silver")),
                          f"{lake}/history")
    return lake_table(spark, f"{lake}/history")


def q_history_reload(spark, sf_dir):
    """The history table loaded whole, then one day of it again, twice: the
    day is replaced, the others stay."""
    lake = _written_silver(spark, sf_dir, "history-day")
    for day in (None, "2024-01-15", "2024-01-15"):
        medallion.load_history(spark, lake, day)
    return lake_table(spark, lake.history)


def _written_silver(spark, sf_dir, label):
    root = run_dir(spark, label)
    medallion.write_silver(_trades(spark, sf_dir), f"{root}/silver", processed_at=RUN_CLOCK)
    return medallion.LakePaths(root)


def _state_partitions(spark):
    # one state partition per core of this session; set explicitly at scale
    return spark.sparkContext.defaultParallelism


def _run_gold(spark, lake, checkpoint="gold"):
    stages.await_done(stages.start_gold_batches(spark, lake.silver, BatchFileSink(lake.gold),
                                                lake.checkpoint(checkpoint), ingested_at=RUN_CLOCK,
                                                state_partitions=_state_partitions(spark)))
    return medallion.gold_table(spark, lake)


def q_stream_candles(spark, sf_dir):
    lake = _written_silver(spark, sf_dir, "stream-candles")
    stages.await_done(stages.start_gold_files(spark, lake.silver, lake.gold,
                                              lake.checkpoint("gold"), ingested_at=RUN_CLOCK,
                                              state_partitions=_state_partitions(spark)))
    return lake_table(spark, lake.gold)


def q_stream_gold_sink(spark, sf_dir):
    return _run_gold(spark, _written_silver(spark, sf_dir, "stream-gold"))


def q_stream_live_candles(spark, sf_dir):
    """Emitted candles and the open windows in the stream's state."""
    lake = _written_silver(spark, sf_dir, "stream-live")
    return state.live_candles(_run_gold(spark, lake), lake.checkpoint("gold"), RUN_CLOCK)


def _two_loads(spark, sf_dir, label):
    """A silver lake that grows: (lake, add the first part, add the rest)."""
    whole = lake_table(spark, _written_silver(spark, sf_dir, f"{label}-all").silver)
    early = (F.col("trade_timestamp") < F.lit(RESTART_DAY).cast("timestamp")) & (
        F.unix_millis("trade_timestamp") % LATE_EVERY != 0)
    lake = medallion.LakePaths(run_dir(spark, label))

    def add(rows):
        return lambda: rows.write.mode("append").partitionBy(*schemas.SILVER_PARTITIONS).parquet(lake.silver)

    return lake, add(whole.filter(early)), add(whole.filter(~early))


def q_stream_gold_restart(spark, sf_dir):
    """The gold stream run, then run again on the same checkpoint after new
    trades came: state goes on, and trades behind the watermark are late."""
    lake, first, rest = _two_loads(spark, sf_dir, "stream-restart")
    first()
    _run_gold(spark, lake)
    rest()
    return _run_gold(spark, lake)


def q_stream_gold_new_checkpoint(spark, sf_dir):
    """The same with a new checkpoint for the second run: it sees all trades
    anew, and nothing that the first run stored gets lost."""
    lake, first, rest = _two_loads(spark, sf_dir, "stream-two-checkpoints")
    first()
    _run_gold(spark, lake, "gold-1")
    rest()
    return _run_gold(spark, lake, "gold-2")


def q_stream_late_merge(spark, sf_dir):
    """The same silver lake, growing by late trades, through the mergeable
    states: two runs on one checkpoint, and nothing is dropped."""
    lake, first, rest = _two_loads(spark, sf_dir, "stream-late")
    first()
    medallion.run_partials(spark, lake)
    rest()
    medallion.run_partials(spark, lake)
    return medallion.merged_candles(spark, lake, RUN_CLOCK)


def q_candles_1h_from_states(spark, sf_dir):
    """Hourly candles from the states of two parts of the trades, by minute."""
    rows = _silver(spark, sf_dir)
    late = F.unix_millis("trade_timestamp") % LATE_EVERY == 0
    parts = [partials.partial_candles(rows.where(c)) for c in (~late, late)]
    return partials.candles_from(partials.coarser(partials.merge(*parts), "hour"), RUN_CLOCK)


def q_overview_from_states(spark, sf_dir):
    """The overview at several clocks, from hourly states and edge minutes."""
    lake = medallion.LakePaths(run_dir(spark, "rollups"))
    partials.stored(spark, lake.partials).merge(partials.partial_candles(_silver(spark, sf_dir)), partials.merge)
    out = None
    for clock in ROLLING_CLOCKS:
        one = medallion.rolled_overview(spark, lake, clock).withColumn("as_of", F.lit(clock))
        out = one if out is None else out.unionByName(one)
    return out


def _land_messages(spark, sf_dir, lake):
    fixtures.with_garbage(envelope.keyed_json(_trades(spark, sf_dir))).write.mode("append").json(lake.landing)


def _delivered_twice(spark, sf_dir, label):
    """All messages through one checkpoint of the bronze stream, and all of
    them again through a new one."""
    lake = medallion.LakePaths(run_dir(spark, label))
    for checkpoint in ("bronze-1", "bronze-2"):
        _land_messages(spark, sf_dir, lake)
        medallion.run_incremental(spark, lake, RUN_CLOCK, checkpoint)
    return lake


def q_incremental_silver(spark, sf_dir):
    """Silver of two deliveries: the second adds no row."""
    return incremental.silver_rows(spark, _delivered_twice(spark, sf_dir, "incremental").silver).drop("load")


def q_incremental_candles(spark, sf_dir):
    return medallion.merged_candles(spark, _delivered_twice(spark, sf_dir, "incremental-candles"), RUN_CLOCK)


def _split_twice(spark, sf_dir, label):
    """Two runs of the splitting sink; the second has late trades."""
    lake = medallion.LakePaths(run_dir(spark, label))
    rows = _trades(spark, sf_dir)
    early = (F.col("trade_time") < F.unix_millis(F.lit(RESTART_DAY).cast("timestamp"))) & (F.col("trade_time") % LATE_EVERY != 0)
    for part in (F.coalesce(early, F.lit(False)), ~F.coalesce(early, F.lit(False))):
        envelope.keyed_json(rows.where(part)).write.mode("append").json(lake.landing)
        stages.await_done(stages.start_split(message_files(spark, lake.landing), lake.bronze, lake.checkpoint("split"),
                                             files_per_partition=1))
    return lake.bronze


def q_stream_dead_letters(spark, sf_dir):
    """Rejected messages and why."""
    return deadletters.stored(spark, _split_twice(spark, sf_dir, "dead-letters"), "rejected").select(
        "symbol", "price", "quantity", "trade_time", "trade_id", "key", "reason")


def q_stream_accepted(spark, sf_dir):
    return deadletters.stored(spark, _split_twice(spark, sf_dir, "accepted"), "accepted")


def q_history_recursive(spark, sf_dir):
    """Silver files at several depths, with columns missing, added and of
    other types, loaded into the history table in one scan."""
    root = run_dir(spark, "history-tree")
    rows = _silver(spark, sf_dir).drop(*schemas.SILVER_PARTITIONS).persist()
    part = F.pmod(F.unix_millis("trade_timestamp"), F.lit(4))
    shapes = {"a": lambda df: df, "a/b/c": lambda df: df.drop("ingest_timestamp").withColumn("venue", F.lit("x")),
              "d/2024/01": lambda df: df.withColumn("price", F.col("price").cast("string")),
              "e": lambda df: df.select("quantity", "price", "symbol", "trade_timestamp", "is_buyer_maker", "ingest_timestamp")}
    for k, (folder, shape) in enumerate(shapes.items()):
        shape(rows.where(part == k)).write.parquet(f"{root}/{folder}/rows")
    rows.unpersist()
    return history.history_rows(history.scan(spark, root).rows)


def _stream_silver(spark, sf_dir, label, first_seen):
    """Landed messages -> bronze stream -> silver stream; the committed silver."""
    lake = medallion.LakePaths(run_dir(spark, label))
    _land_messages(spark, sf_dir, lake)
    stages.await_done(stages.start_bronze(message_files(spark, lake.landing), lake.bronze,
                                          lake.checkpoint("bronze"), files_per_partition=1))
    stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver,
                                          lake.checkpoint("silver"), processed_at=RUN_CLOCK,
                                          state_partitions=_state_partitions(spark),
                                          first_seen=first_seen, files_per_partition=1))
    return lake_table(spark, lake.silver)


def q_stream_bronze_silver(spark, sf_dir):
    """Which copy of a trade a stream sees first depends on the files' order;
    the columns here are the same for all copies."""
    return _stream_silver(spark, sf_dir, "stream-silver", first_seen=True).drop(
        "source", "is_buyer_maker", "trade_id", "ingest_timestamp", "trade_side")


def q_stream_silver_first_arrival(spark, sf_dir):
    """Silver stream de-duplicated by the watermarked aggregate: keys up to
    the watermark are emitted, each with its first arrival."""
    return _stream_silver(spark, sf_dir, "stream-silver-first-arrival", first_seen=False)


def _lake_mart(name):
    def query(spark, sf_dir):
        """The whole batch medallion: silver, candles, sentiment and the four
        marts written as tables in a fresh lake; one mart read back."""
        lake = medallion.LakePaths(run_dir(spark, "lake"))
        medallion.run_batch(spark, _trades(spark, sf_dir), _sentiment(spark, sf_dir), lake,
                            as_of=RUN_CLOCK, processed_at=RUN_CLOCK)
        return lake.warehouse(spark).source(name)
    return query


def q_lake_sentiment_twice(spark, sf_dir):
    """Two sentiment loads for the same dates, the second with revisions, then
    the marts: one row per day, with the newest reading."""
    ev = _events(spark, sf_dir)
    lake = medallion.LakePaths(run_dir(spark, "lake-sentiment"))
    medallion.run_batch(spark, _trades(spark, sf_dir), fixtures.sentiment_rows(ev, RUN_CLOCK), lake,
                        as_of=RUN_CLOCK, processed_at=RUN_CLOCK)
    sentiment.store_latest(spark, fixtures.sentiment_revisions(ev, NEXT_LOAD_CLOCK), lake.sentiment)
    medallion.build_marts(spark, lake, RUN_CLOCK)
    return lake.warehouse(spark).source("mart_price_vs_sentiment")


def _streamed_lake(spark, sf_dir):
    lake = medallion.LakePaths(run_dir(spark, "stream-lake"))
    _land_messages(spark, sf_dir, lake)
    medallion.run_streaming(spark, lake, processed_at=RUN_CLOCK, first_seen=False,
                            state_partitions=_state_partitions(spark))
    return lake


def q_stream_lake_market_overview(spark, sf_dir):
    """The streaming medallion in stage order (bronze, silver, gold streams),
    then the marts rebuilt from the gold lake; returns the overview mart."""
    lake = _streamed_lake(spark, sf_dir)
    medallion.build_marts_from_lake(spark, lake, RUN_CLOCK, _sentiment(spark, sf_dir))
    return lake.warehouse(spark).source("mart_market_overview")


def q_lake_data_tests(spark, sf_dir):
    """The batch medallion, then the data tests of all its tables."""
    lake = medallion.LakePaths(run_dir(spark, "lake-tests"))
    medallion.run_batch(spark, _trades(spark, sf_dir), _sentiment(spark, sf_dir), lake,
                        as_of=RUN_CLOCK, processed_at=RUN_CLOCK)
    return medallion.run_tests(spark, lake, RUN_CLOCK)


def q_candle_violations(spark, sf_dir):
    """The violations that the data tests store for candles with planted faults."""
    root = run_dir(spark, "faulty-candles")
    fixtures.faulty_candles(_candles(spark, sf_dir)).write.parquet(f"{root}/candles")
    rows = lake_table(spark, f"{root}/candles")
    checks.run_checks(spark, {medallion.CANDLES: contracts.candle_checks(rows)}, f"{root}/violations")
    return checks.violations(spark, f"{root}/violations").drop("row")


def _stored_order(name, *columns):
    def query(spark, sf_dir):
        """Places of a mart's rows as they are stored, file by file."""
        lake = medallion.LakePaths(run_dir(spark, "lake-order"))
        medallion.run_batch(spark, _trades(spark, sf_dir), _sentiment(spark, sf_dir), lake,
                            as_of=RUN_CLOCK, processed_at=RUN_CLOCK)
        return with_position(spark, f"{lake.marts}/{name}").select("position", *columns)
    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fx_trades": q_fx_trades,
    "silver_clean": q_silver_clean,
    "silver_enriched": q_silver_enriched,
    "silver_dedup": q_silver_dedup,
    "candles_1m": q_candles_1m,
    "candles_1h": q_candles_1h,
    "mart_market_overview": q_market_overview,
    "mart_market_overview_fresh_clock": q_market_overview_fresh,
    "mart_ohlc_summary": q_ohlc_summary,
    "mart_pipeline_health": q_pipeline_health,
    "mart_pipeline_health_run_clock": q_pipeline_health_run,
    "sentiment_parsed": q_sentiment_parsed,
    "sentiment_upsert": q_sentiment_upsert,
    "mart_price_vs_sentiment": q_price_vs_sentiment,
    "envelope_normalized": q_envelope_normalized,
    "keyed_json": q_keyed_json,
    "bronze_trades": q_bronze_trades,
    "history_load": q_history_load,
    "history_reload": q_history_reload,
    "stream_candles": q_stream_candles,
    "stream_gold_sink": q_stream_gold_sink,
    "stream_bronze_silver": q_stream_bronze_silver,
    "stream_silver_first_arrival": q_stream_silver_first_arrival,
    "stream_gold_restart": q_stream_gold_restart,
    "stream_gold_new_checkpoint": q_stream_gold_new_checkpoint,
    "stream_late_merge": q_stream_late_merge,
    "candles_1h_from_states": q_candles_1h_from_states,
    "overview_from_states": q_overview_from_states,
    "incremental_silver": q_incremental_silver,
    "incremental_candles": q_incremental_candles,
    "stream_dead_letters": q_stream_dead_letters,
    "stream_accepted": q_stream_accepted,
    "history_recursive": q_history_recursive,
    "stream_live_candles": q_stream_live_candles,
    "lake_market_overview": _lake_mart("mart_market_overview"),
    "lake_ohlc_summary": _lake_mart("mart_ohlc_summary"),
    "lake_pipeline_health": _lake_mart("mart_pipeline_health"),
    "lake_price_vs_sentiment": _lake_mart("mart_price_vs_sentiment"),
    "lake_sentiment_twice": q_lake_sentiment_twice,
    "stream_lake_market_overview": q_stream_lake_market_overview,
    "lake_pipeline_health_order": _stored_order("mart_pipeline_health", "ingestion_hour", "symbol", "candles_count"),
    "lake_price_vs_sentiment_order": _stored_order("mart_price_vs_sentiment", "date", "symbol", "avg_price"),
    "lake_data_tests": q_lake_data_tests,
    "candle_violations": q_candle_violations,
}
QUERIES = {name: _in_own_session(query) for name, query in QUERIES.items()}
