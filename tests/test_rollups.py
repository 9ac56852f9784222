import pytest

from tests.helpers import collect_sorted, trade, trades
from tests.test_partials import append, many, silver_rows
from tickforge.operators import candles, marts, partials, rollups
from tickforge.plans import medallion

CLOCKS = ["2024-01-02 01:00:00", "2024-01-02 01:29:30", "2024-01-03 00:00:00", "2024-01-04 02:59:59", "2024-02-01 00:00:00"]


def overview(rows, clock):
    return collect_sorted(marts.market_overview(candles.candles(rows, ingested_at=CLOCKS[-1]), clock), "symbol")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_direct_mart_at_any_clock(spark, fresh_dir, seed):
    rows = silver_rows(spark, many(seed, n=900, days=4)).persist()
    lake = medallion.LakePaths(fresh_dir)
    partials.stored(spark, lake.partials).merge(partials.partial_candles(rows), partials.merge)
    for clock in CLOCKS:
        assert collect_sorted(medallion.rolled_overview(spark, lake, clock), "symbol") == overview(rows, clock)
    assert overview(rows, CLOCKS[0]) and not overview(rows, CLOCKS[-1])
    rows.unpersist()


def test_late_trades_reach_the_overview_and_refresh_their_days_only(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    first = silver_rows(spark, many(3, days=4))
    append(first, lake)
    medallion.run_partials(spark, lake)
    hours, minutes = partials.stored(spark, lake.hours), partials.stored(spark, lake.partials)
    assert rollups.refresh_hours(hours, minutes) == [f"2024-01-0{d}" for d in range(1, 5)]
    assert rollups.refresh_hours(hours, minutes) == []
    late = silver_rows(spark, [trade(symbol="A", price=999.0, at="2024-01-03 01:30:00")])
    append(late, lake)
    medallion.run_partials(spark, lake)
    assert rollups.refresh_hours(hours, minutes) == ["2024-01-03"]
    got = collect_sorted(rollups.stored_overview(spark, hours, minutes, "2024-01-04 01:00:00"), "symbol")
    assert got == overview(first.unionByName(late), "2024-01-04 01:00:00")
    assert {r["symbol"]: r["high_24h"] for r in got}["A"] == 999.0


def test_the_window_reads_hours_and_edge_minutes(spark, fresh_dir):
    """Rows read: one for each symbol and hour, and the edge's minutes."""
    rows = spark.range(2 * 86_400).selectExpr(
        "concat('S', id % 2) as symbol", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) as trade_timestamp",
        "id as trade_id", "1.0d + id % 7 as price", "0.5d as quantity", "id % 3 = 0 as is_buyer_maker")
    lake = medallion.LakePaths(fresh_dir)
    hours, minutes = partials.stored(spark, lake.hours), partials.stored(spark, lake.partials)
    minutes.merge(partials.partial_candles(rows), partials.merge)
    rollups.refresh_hours(hours, minutes)
    assert (minutes.rows().count(), hours.rows().count()) == (2 * 2880, 2 * 48)
    parts = rollups.window_parts(hours.rows(), minutes.rows(), "2024-01-03 00:20:00")
    assert parts.count() == 2 * 23 + 2 * 40
    read = rollups.stored_overview(spark, hours, minutes, "2024-01-03 00:20:00")
    assert {f.split("bucket=")[1][:10] for f in read.inputFiles()} == {"2024-01-02"}
    assert [(r.symbol, r.total_trades_24h) for r in read.orderBy("symbol").collect()] == [("S0", 42600), ("S1", 42600)]


def test_empty_states(spark, fresh_dir):
    assert medallion.rolled_overview(spark, medallion.LakePaths(fresh_dir), CLOCKS[0]).count() == 0
