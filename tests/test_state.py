from pyspark.sql import functions as F

from tests.helpers import collect_sorted
from tests.test_partials import CLOCK, append, many, silver_rows
from tickforge import schemas
from tickforge.operators import candles, partials
from tickforge.plans import medallion
from tickforge.sources.streams import lake_table
from tickforge.streaming import sinks, stages, state


def run(spark, lake, parts=3):
    stages.await_done(stages.start_gold_files(spark, lake.silver, lake.gold, lake.checkpoint("gold"), ingested_at=CLOCK, state_partitions=parts))


def test_open_windows_are_in_the_state(spark, fresh_dir):
    """Emitted candles and open windows are all candles of the trades."""
    lake = medallion.LakePaths(fresh_dir)
    rows = silver_rows(spark, [{**r, "trade_time": r["trade_time"] % 900_000 + 1_704_067_200_000} for r in many(11, n=500)])
    append(rows, lake)
    run(spark, lake)
    checkpoint = lake.checkpoint("gold")
    info = state.operators(spark, checkpoint).collect()
    assert [(r.operatorName, r.numPartitions) for r in info] == [("stateStoreSave", 3)]
    held = state.open_windows(spark, checkpoint)
    emitted = lake_table(spark, lake.gold)
    assert held.count() > 5 and emitted.count() > 5
    assert held.join(emitted, ["candle_start_time", "symbol"]).count() == 0
    want = candles.candles(rows, ingested_at=CLOCK)
    live = state.live_candles(emitted, checkpoint, CLOCK)
    key = ("symbol", "candle_start_time")
    assert collect_sorted(live, *key) == collect_sorted(want.select(*live.columns), *key)
    by_part = state.spread(spark, checkpoint)
    assert by_part.agg(F.sum("windows"), F.sum("trades")).first() == (held.count(), held.agg(F.sum("trade_count")).first()[0])
    # states of the open windows merge with what comes later, as the stream itself does it
    later = silver_rows(spark, [{**r, "trade_time": r["trade_time"] % 300_000 + 1_704_067_800_000, "price": r["price"] + 100} for r in many(12, n=80)])
    merged = partials.candles_from(partials.merge(held, partials.partial_candles(later)), CLOCK)
    append(later, lake)
    run(spark, lake)
    again = state.live_candles(lake_table(spark, lake.gold), checkpoint, CLOCK)
    newer = again.join(held.select(*key), list(key), "left_semi").select(*merged.columns)
    assert collect_sorted(newer, *key) == collect_sorted(merged.join(held.select(*key), list(key), "left_semi"), *key)


def test_a_stream_moves_to_another_number_of_state_partitions(spark, fresh_dir):
    """Moved between batches: the same candles as one unbroken stream, none twice."""
    lake, whole = medallion.LakePaths(f"{fresh_dir}/a"), medallion.LakePaths(f"{fresh_dir}/b")
    base = 1_704_153_000_000  # ten minutes before midnight: open windows reach over two days
    batches = [silver_rows(spark, [{**r, "trade_time": r["trade_time"] % 900_000 + base + k * 700_000} for r in many(20 + k, n=300)])
               for k in range(4)]

    def batch_stream(lake, rows, start):
        append(rows, lake)
        stages.await_done(start())

    def plain(lake):
        return lambda: stages.start_gold_batches(spark, lake.silver, sinks.BatchFileSink(lake.gold), lake.checkpoint("gold"),
                                                 ingested_at=CLOCK, state_partitions=2)

    old, new = lake.checkpoint("gold"), lake.checkpoint("gold-5")
    for k, rows in enumerate(batches):
        batch_stream(whole, rows, plain(whole))
        batch_stream(lake, rows, plain(lake) if k < 2 else lambda: state.move_candles(
            spark, lake.silver, lake.gold, old, new, 5, ingested_at=CLOCK))
    key = ("symbol", "candle_start_time")
    raw = spark.read.schema(sinks.stored_schema(schemas.CANDLE)).parquet(lake.gold)
    assert raw.groupBy(*key).count().where("count > 1").isEmpty()
    got = sinks.read_latest(spark, lake.gold, list(key))
    want = sinks.read_latest(spark, whole.gold, list(key))
    assert want.count() > 30 and collect_sorted(got.select(*want.columns), *key) == collect_sorted(want, *key)
    assert [r.numPartitions for r in state.operators(spark, new).collect()] == [5]
    assert collect_sorted(state.open_windows(spark, new), *key) == collect_sorted(
        state.open_windows(spark, whole.checkpoint("gold")), *key)
    assert state.watermark(spark, new) == state.watermark(spark, whole.checkpoint("gold"))
