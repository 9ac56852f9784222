import os
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import collect_sorted, shuffle_records_written, trade, trades
from tickforge import schemas
from tickforge.operators import candles, partials, silver
from tickforge.plans import medallion
from tickforge.streaming import stages

CLOCK = "2024-02-01 00:00:00"


def silver_rows(spark, rows):
    return silver.silver_batch(trades(spark, rows), processed_at=CLOCK)


def many(seed, n=600, days=3):
    rng = random.Random(seed)
    return [trade(symbol=rng.choice(["A", "B", None]) or "C", price=rng.randrange(1, 64) / 4, quantity=rng.randrange(1, 9) / 4,
                  side=rng.choice([True, False, None]), trade_id=rng.choice([None, rng.randrange(10 ** 12)]),
                  at=f"2024-01-{1 + rng.randrange(days):02d} 0{rng.randrange(3)}:{rng.randrange(60):02d}:{rng.randrange(60):02d}") for _ in range(n)]


def same(a, b):
    assert collect_sorted(a, "symbol", "candle_start_time") == collect_sorted(b, "symbol", "candle_start_time")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_states_of_any_parts_merge_into_the_whole(spark, seed):
    rows = silver_rows(spark, many(seed)).persist()
    part = F.pmod(F.xxhash64("symbol", "trade_timestamp", "price", "trade_id"), F.lit(4))
    states = [partials.partial_candles(rows.where(part == k)) for k in range(4)]
    left = partials.merge(partials.merge(states[2], states[0]), partials.merge(states[3], states[1]))
    same(partials.candles_from(left, CLOCK), candles.candles(rows, ingested_at=CLOCK))
    for unit in ("hour", "day"):
        same(partials.candles_from(partials.coarser(left, unit), CLOCK), candles.candles(rows, f"1 {unit}", CLOCK))
    assert partials.candles_from(left, CLOCK).schema.simpleString() == candles.candles(rows, ingested_at=CLOCK).schema.simpleString()
    rows.unpersist()


def append(rows, lake):
    rows.write.mode("append").partitionBy(*schemas.SILVER_PARTITIONS).parquet(lake.silver)


def test_late_trades_change_only_their_days(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    first = silver_rows(spark, many(7, days=5))
    append(first, lake)
    medallion.run_partials(spark, lake)
    same(medallion.merged_candles(spark, lake, CLOCK), candles.candles(first, ingested_at=CLOCK))
    before = partials.stored(spark, lake.partials).commit()
    late = silver_rows(spark, [trade(symbol="A", price=0.125, quantity=7.0, trade_id=-1, at="2024-01-02 00:00:00"),
                               trade(symbol="NEW", price=5.0, at="2024-01-02 09:00:00")])
    append(late, lake)
    medallion.run_partials(spark, lake)
    after = partials.stored(spark, lake.partials).commit()
    assert {b for b in after.buckets if after.buckets[b] != before.buckets.get(b)} == {"2024-01-02"}
    same(medallion.merged_candles(spark, lake, CLOCK), candles.candles(first.unionByName(late), ingested_at=CLOCK))


def test_a_replayed_batch_counts_once(spark, fresh_dir):
    """The run fails after the batch was merged; the rerun replays it."""
    lake = medallion.LakePaths(fresh_dir)
    rows = silver_rows(spark, many(9, n=100))
    append(rows, lake)
    real = partials.PartialCandleSink.__call__

    def broken(self, df, batch_id):
        real(self, df, batch_id)
        raise RuntimeError("after the merge")

    partials.PartialCandleSink.__call__ = broken
    try:
        with pytest.raises(Exception, match="after the merge"):
            stages.await_done(stages.start_partials(spark, lake.silver, lake.partials, lake.checkpoint("partials")))
    finally:
        partials.PartialCandleSink.__call__ = real
    medallion.run_partials(spark, lake)
    same(medallion.merged_candles(spark, lake, CLOCK), candles.candles(rows, ingested_at=CLOCK))
    assert partials.stored(spark, lake.partials).commit().number == 1


def test_a_hot_minute_is_combined_before_the_shuffle(spark):
    rows = spark.range(40_000, numPartitions=4).selectExpr(
        "'A' as symbol", "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 50) as trade_timestamp", "id as trade_id",
        "1.0d as price", "1.0d as quantity", "id % 2 = 0 as is_buyer_maker")
    assert shuffle_records_written(partials.partial_candles(rows)) == [4]


def test_marts_from_the_states(spark, fresh_dir):
    from tickforge.operators import envelope
    lake = medallion.LakePaths(fresh_dir)
    rows = [trade(symbol=s, price=100.0 + m, trade_id=m, at=f"2024-01-01 00:{m:02d}:05") for m in range(30) for s in ("BTCUSDT", "ETHUSDT")]
    envelope.keyed_json(trades(spark, rows)).write.json(lake.landing)
    medallion.main(["--lake", fresh_dir, "--as-of", "2024-01-01 01:00:00", "--timeout", "180",
                    "--stages", "bronze,silver,partials,marts,tests"])
    overview = spark.read.parquet(f"{lake.marts}/mart_market_overview").collect()
    assert sorted(r.symbol for r in overview) == ["BTCUSDT", "ETHUSDT"]
    assert all(r.total_trades_24h == 30 for r in overview)      # open windows too
    assert os.path.isdir(lake.tests)
