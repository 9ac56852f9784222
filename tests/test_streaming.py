import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import trade, trades
from tickforge import schemas
from tickforge.operators import candles, envelope, silver
from tickforge.plans import medallion
from tickforge.sources.streams import lake_table
from tickforge.streaming import stages
from tickforge.streaming.sinks import BatchFileSink, read_latest

CLOCK = "2024-01-02 00:00:00"


def _totals(spark):
    listener = stages.ProgressTotals()
    spark.streams.addListener(listener)
    return listener


def _late(listener, query):
    """Rows dropped as late; progress reports arrive a little later."""
    import time
    for _ in range(50):
        if str(query.id) in listener.late:
            time.sleep(0.5)
            break
        time.sleep(0.1)
    return listener.late.get(str(query.id), 0)


def _append_silver(spark, rows, path):
    df = silver.silver_batch(trades(spark, rows), processed_at=CLOCK)
    df.write.mode("append").partitionBy(*schemas.SILVER_PARTITIONS).parquet(path)


def _minute_trades(minutes, symbol="BTCUSDT", second=5):
    return [trade(symbol=symbol, price=100.0 + m, quantity=1.0, trade_id=m,
                  at=f"2024-01-01 00:{m:02d}:{second:02d}") for m in minutes]


def test_stream_equals_batch_after_watermark_cutoff(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    rows = _minute_trades(range(0, 30)) + _minute_trades(range(0, 12), symbol="ETHUSDT")
    _append_silver(spark, rows, lake.silver)
    q = stages.start_gold_files(spark, lake.silver, lake.gold, lake.checkpoint("gold"),
                                ingested_at=CLOCK)
    stages.await_done(q, 120)
    got = lake_table(spark, lake.gold)
    batch = candles.candles(lake_table(spark, lake.silver), ingested_at=CLOCK)
    # watermark = max event time (00:29:05) - 10 min; windows ending by then are final
    cutoff = dt.datetime(2024, 1, 1, 0, 19, 5)
    expected = batch.filter(F.col("candle_start_time") + F.expr("INTERVAL 1 MINUTE")
                            <= F.lit(cutoff))
    assert got.count() == expected.count() == 19 + 12
    assert got.exceptAll(expected).count() == 0


def test_late_rows_are_dropped_and_restart_adds_nothing(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    _append_silver(spark, _minute_trades(range(0, 30)), lake.silver)
    run = lambda: stages.await_done(stages.start_gold_files(
        spark, lake.silver, lake.gold, lake.checkpoint("gold"), ingested_at=CLOCK), 120)
    totals = _totals(spark)
    q = run()
    assert _late(totals, q) == 0
    first = lake_table(spark, lake.gold).count()
    assert first == 19
    run()                                     # same checkpoint, no new data
    assert lake_table(spark, lake.gold).count() == first
    late = [trade(price=500.0, quantity=7.0, trade_id=900, at="2024-01-01 00:03:30")]  # behind
    _append_silver(spark, late + _minute_trades(range(30, 45)), lake.silver)
    q = run()
    assert _late(totals, q) == 1
    spark.streams.removeListener(totals)
    out = lake_table(spark, lake.gold)
    m3 = out.filter(F.col("candle_start_time") == F.lit(dt.datetime(2024, 1, 1, 0, 3))).collect()
    assert len(m3) == 1 and m3[0].trade_count == 1 and m3[0].high_price == 103.0
    assert out.count() == 34                  # windows up to 00:34 closed (max 00:44:05 - 10 min)
    assert out.groupBy("symbol", "candle_start_time").count().filter("count > 1").count() == 0


def test_batch_file_sink_is_idempotent(spark, fresh_dir):
    def query(name):                          # a checkpoint as Spark leaves it
        spark.createDataFrame([(f'{{"id":"{name}"}}',)], "value string").coalesce(1).write.text(f"{fresh_dir}/{name}/metadata")
        return BatchFileSink(f"{fresh_dir}/gold", f"{fresh_dir}/{name}")

    sink = query("one")
    df = candles.candles(silver.silver_batch(trades(spark, _minute_trades(range(3)))), ingested_at=CLOCK)
    sink(df, 0)
    sink(df, 0)                               # replayed batch: replaces, no second copy
    later = df.limit(1).withColumn("trade_count", F.lit(99).cast("long"))
    sink(later, 1)
    sink(df.limit(0), 2)                      # nothing to store: no folder
    out = read_latest(spark, f"{fresh_dir}/gold", ["symbol", "candle_start_time"])
    assert out.count() == 3
    assert sorted(r.trade_count for r in out.collect()) == [1, 1, 99]
    other = query("two")                      # another checkpoint counts its batches from 0 again
    other(df.withColumn("symbol", F.lit("NEW")), 0)
    again = read_latest(spark, f"{fresh_dir}/gold", ["symbol", "candle_start_time"])
    assert again.count() == 6 and sorted(r.trade_count for r in again.collect()) == [1, 1, 1, 1, 1, 99]
    folders = {(r.run, r.batch_id) for r in spark.read.parquet(f"{fresh_dir}/gold").select("run", "batch_id").collect()}
    assert folders == {("one", 0), ("one", 1), ("two", 0)}


def test_streaming_silver_dedupes_redelivery_across_batches(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    msgs = trades(spark, _minute_trades(range(0, 5)))
    envelope.keyed_json(msgs).write.mode("append").json(lake.landing)
    landing = lambda: __import__("tickforge.sources.streams", fromlist=["x"]).message_files(
        spark, lake.landing)
    stages.await_done(stages.start_bronze(landing(), lake.bronze, lake.checkpoint("bronze")), 120)
    stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver, lake.checkpoint("silver"),
                                          processed_at=CLOCK), 120)
    # the same messages again (redelivery) plus one new trade
    again = trades(spark, _minute_trades(range(0, 6)))
    envelope.keyed_json(again).write.mode("append").json(lake.landing)
    stages.await_done(stages.start_bronze(landing(), lake.bronze, lake.checkpoint("bronze")), 120)
    stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver, lake.checkpoint("silver"),
                                          processed_at=CLOCK), 120)
    out = lake_table(spark, lake.silver)
    assert out.count() == 6
    assert lake_table(spark, lake.bronze).count() == 11


def test_full_streaming_medallion_matches_batch(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    rows = _minute_trades(range(0, 40)) + _minute_trades(range(0, 40, 3), symbol="SOLUSDT", second=30)
    rows += [dict(r) for r in rows[:5]]                      # redeliveries
    envelope.keyed_json(trades(spark, rows)).write.mode("overwrite").json(lake.landing)
    got = medallion.run_streaming(spark, lake, processed_at=CLOCK, timeout_s=180)
    batch = candles.candles(silver.silver_batch(trades(spark, rows), processed_at=CLOCK),
                            ingested_at=CLOCK)
    cutoff = dt.datetime(2024, 1, 1, 0, 29, 30)               # max 00:39:30 - 10 min
    expected = batch.filter(F.col("candle_start_time") + F.expr("INTERVAL 1 MINUTE") <= F.lit(cutoff))
    assert got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0


def test_stream_over_many_micro_batches_equals_batch(spark, fresh_dir):
    """State and watermark carried across micro-batches: silver arrives in
    three appends in time order, each followed by a run."""
    lake = medallion.LakePaths(fresh_dir)
    totals = _totals(spark)
    for lo in (0, 10, 20):
        part = _minute_trades(range(lo, lo + 10)) + _minute_trades(range(lo, lo + 10, 2),
                                                                   symbol="ETHUSDT", second=40)
        _append_silver(spark, part, lake.silver)
        q = stages.await_done(stages.start_gold_files(spark, lake.silver, lake.gold,
                                                      lake.checkpoint("gold"), ingested_at=CLOCK), 180)
        assert _late(totals, q) == 0
    spark.streams.removeListener(totals)
    got = lake_table(spark, lake.gold)
    batch = candles.candles(lake_table(spark, lake.silver), ingested_at=CLOCK)
    cutoff = dt.datetime(2024, 1, 1, 0, 19, 40)               # max 00:29:40 - 10 min
    expected = batch.filter(F.col("candle_start_time") + F.expr("INTERVAL 1 MINUTE") <= F.lit(cutoff))
    assert got.count() == expected.count() == 19 + 10
    assert got.exceptAll(expected).count() == 0


class _FailAfterFirstWrite:
    """A sink that stores the first non-empty batch and then fails, as if the
    driver were lost between the write and the batch commit."""

    def __init__(self, inner):
        self.inner, self.failed = inner, False

    def __call__(self, df, batch_id):
        self.inner(df, batch_id)
        if not self.failed and not df.isEmpty():
            self.failed = True
            raise RuntimeError("lost after writing")


def test_sink_failure_fails_the_run_and_rerun_stores_one_copy(spark, fresh_dir):
    import pytest
    lake = medallion.LakePaths(fresh_dir)
    _append_silver(spark, _minute_trades(range(0, 30)), lake.silver)
    ckpt = lake.checkpoint("gold")
    failing = _FailAfterFirstWrite(BatchFileSink(lake.gold, ckpt))
    with pytest.raises(Exception, match="lost after writing"):
        stages.await_done(stages.start_gold_batches(spark, lake.silver, failing, ckpt,
                                                    ingested_at=CLOCK), 120)
    assert failing.failed                          # the batch was written, then not committed
    stages.await_done(stages.start_gold_batches(spark, lake.silver, BatchFileSink(lake.gold),
                                                ckpt, ingested_at=CLOCK), 120)
    raw = spark.read.parquet(lake.gold)            # every batch folder, replayed one included
    assert raw.groupBy("symbol", "candle_start_time").count().filter("count > 1").count() == 0
    assert read_latest(spark, lake.gold, ["symbol", "candle_start_time"]).count() == 19


def test_aggregate_dedupe_stream_keeps_first_arrival_and_equals_batch(spark, fresh_dir):
    """Copies landed before the original, with the other side: the aggregate
    mode keeps the earliest ingest (deterministic, as in batch), emits keys
    the watermark has passed, and combines copies before the state shuffle."""
    from tickforge.sources.streams import message_files
    lake = medallion.LakePaths(fresh_dir)
    originals = _minute_trades(range(0, 30)) + [trade(price=500.0, trade_id=99,
                                                      at="2024-01-01 00:29:30")]
    copies = [trade(price=103.0, quantity=1.0, trade_id=3, at="2024-01-01 00:03:05", side=True,
                    ingested=f"2024-01-01T00:{10 + i % 40:02d}:00") for i in range(200)]
    envelope.keyed_json(trades(spark, copies)).write.mode("append").json(lake.landing)
    envelope.keyed_json(trades(spark, originals)).write.mode("append").json(lake.landing)
    stages.await_done(stages.start_bronze(message_files(spark, lake.landing), lake.bronze,
                                          lake.checkpoint("bronze")), 120)
    q = stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver,
                                              lake.checkpoint("silver"), processed_at=CLOCK,
                                              first_seen=False), 120)
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    below_exchange = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "Aggregate" in below_exchange and "partial_min" in below_exchange   # combined before the shuffle
    got = lake_table(spark, lake.silver)
    batch = silver.silver_batch(trades(spark, copies + originals), processed_at=CLOCK)
    watermark = dt.datetime(2024, 1, 1, 0, 19, 30)          # max 00:29:30 - 10 min
    expected = batch.filter(F.col("trade_timestamp") <= F.lit(watermark))
    assert got.count() == expected.count() == 20
    assert got.exceptAll(expected).count() == 0
    hot = got.filter(F.col("price") == 103.0).collect()
    assert len(hot) == 1 and hot[0].trade_side == "BUY" and hot[0].is_buyer_maker is False
