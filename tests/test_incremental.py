import os

import pytest

from tests.helpers import collect_sorted, trade, trades
from tickforge.operators import candles, envelope, silver
from tickforge.plans import medallion
from tickforge.sources.streams import MESSAGE_FILE_SCHEMA
from tickforge.streaming import incremental

CLOCK = "2024-02-01 00:00:00"


def hour(h, n=12, extra=()):
    return [trade(symbol=f"S{k % 3}", price=1.0 + k, trade_id=100 * h + k, at=f"2024-01-{1 + h // 24:02d} {h % 24:02d}:{k:02d}:00")
            for k in range(n)] + list(extra)


def land(spark, lake, rows):
    envelope.keyed_json(trades(spark, rows)).coalesce(1).write.mode("append").json(lake.landing)


def landed(lake):
    return len([f for f in os.listdir(lake.landing) if f.endswith(".json")])


def columns(df):
    return collect_sorted(df.select("symbol", "price", "trade_timestamp", "trade_id", "source", "day"), "symbol", "trade_timestamp", "price")


def same_as_batch(spark, lake, rows):
    want = silver.silver_batch(trades(spark, rows), CLOCK)
    assert columns(incremental.silver_rows(spark, lake.silver)) == columns(want)
    key = ("symbol", "candle_start_time")
    assert collect_sorted(medallion.merged_candles(spark, lake, CLOCK), *key) == collect_sorted(candles.candles(want, ingested_at=CLOCK), *key)


def test_ten_runs_list_what_is_new(spark, fresh_dir, monkeypatch):
    """Files read and listed stay the same from run to run; rows of all runs
    are there, those delivered again once."""
    lake, every, looked, read = medallion.LakePaths(fresh_dir), [], [], []
    real, real_batches = incremental.files.exists, incremental.bronze_batches

    def batches(*args):
        rows, days = real_batches(*args)
        read.append((len(rows.inputFiles()), len(days)))
        return rows, days

    monkeypatch.setattr(incremental.files, "exists", lambda *a: looked.append(1) or real(*a))
    monkeypatch.setattr(incremental, "bronze_batches", batches)
    seen = []
    for k in range(10):
        rows = hour(3 * k)
        every += rows
        land(spark, lake, rows + (hour(3 * k - 3)[:4] if k else []))     # and some of the hour before again
        looked.clear()
        assert medallion.run_incremental(spark, lake, CLOCK) == k + 1
        seen.append((landed(lake), len(looked), len(os.listdir(f"{lake.silver}/_loads"))))
    # landed files of two runs at most; names looked up: next numbers and a load's one or two days
    assert all(a <= 2 and b <= 5 and c == seen[2][2] for a, b, c in seen[2:]), seen
    assert all(n <= 3 for n, _ in read)
    same_as_batch(spark, lake, every)
    assert medallion.run_incremental(spark, lake, CLOCK) is None


def test_redelivery_through_a_new_checkpoint_adds_nothing(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    rows = hour(1) + hour(30)
    for checkpoint in ("a", "b"):
        land(spark, lake, rows)
        medallion.run_incremental(spark, lake, CLOCK, checkpoint)
    assert incremental.done(spark, lake.silver).number == 2
    same_as_batch(spark, lake, rows)
    late = trade(symbol="S0", price=50.0, trade_id=7, at="2024-01-01 01:00:30")
    land(spark, lake, [late])
    medallion.run_incremental(spark, lake, CLOCK, "b")
    same_as_batch(spark, lake, [*rows, late])


@pytest.mark.parametrize("step", ["write", "done"])
def test_a_failed_load_is_written_again(spark, fresh_dir, monkeypatch, step):
    lake = medallion.LakePaths(fresh_dir)
    first, second, third = hour(1), hour(2), hour(27)
    land(spark, lake, first)
    medallion.run_incremental(spark, lake, CLOCK)
    land(spark, lake, second)

    def broken(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, {"write": "not_stored", "done": "_mark"}[step], broken)
        with pytest.raises(OSError, match="lost"):
            medallion.run_incremental(spark, lake, CLOCK)
    assert incremental.silver_rows(spark, lake.silver).count() == len(first)     # readers see what is done
    land(spark, lake, third)
    assert medallion.run_incremental(spark, lake, CLOCK) == 2       # the planned batch
    assert medallion.run_incremental(spark, lake, CLOCK) == 3       # and what came later
    same_as_batch(spark, lake, first + second + third)


def test_only_the_days_of_a_load_are_compared(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    land(spark, lake, hour(1) + hour(30) + hour(60))
    medallion.run_incremental(spark, lake, CLOCK)
    rows = incremental.silver_rows(spark, lake.silver, days=[(2024, 1, 2), (2024, 5, 5)])
    assert rows.count() == 12 and all("day=2/" in f for f in rows.inputFiles())
    assert incremental.silver_rows(spark, lake.silver, days=[(2023, 1, 1)]).count() == 0
    assert incremental.silver_rows(spark, f"{fresh_dir}/nowhere").count() == 0


def test_a_small_load_is_broadcast_to_the_stored_days(spark):
    """The stored side is not shuffled."""
    stored = spark.range(200_000).selectExpr("cast(id as string) as k", "id as v")
    incoming = spark.range(190_000, 200_010, 1000).selectExpr("cast(id as string) as k", "id * 2 as v")
    incoming = incoming.unionByName(spark.createDataFrame([("new", 1)], "k string, v long"))
    out = incremental.not_stored(incoming, stored, ["k"])
    assert {r.k for r in out.collect()} == {"200000", "new"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_messages_without_a_time_are_loaded_by_none(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    spark.createDataFrame([("k", "not json")], MESSAGE_FILE_SCHEMA).write.json(lake.landing)
    assert medallion.run_incremental(spark, lake, CLOCK) == 1
    assert incremental.silver_rows(spark, lake.silver).count() == 0
    assert medallion.merged_candles(spark, lake, CLOCK).count() == 0


def stored_files(lake):
    return {f"{d}/{f}" for d, _, names in os.walk(lake.silver) for f in names if f.endswith(".parquet") and "/_" not in d}


def test_compaction_keeps_rows_and_bounds_files(spark, fresh_dir):
    """Loads go on after it; readers that have opened the table before it go on."""
    lake, every = medallion.LakePaths(fresh_dir), []
    for k in (1, 2, 3, 4, 30, 31):
        every += hour(k)
        land(spark, lake, hour(k))
        medallion.run_incremental(spark, lake, CLOCK)
    assert medallion.compact_silver(spark, lake, least_files=100) == []
    reader = incremental.silver_rows(spark, lake.silver)
    before = stored_files(lake)
    assert medallion.compact_silver(spark, lake, least_files=4) == ["2024-01-01"]       # the newest day is open
    new = stored_files(lake) - before
    assert len(new) == 1 and before < stored_files(lake)
    same_as_batch(spark, lake, every)
    assert reader.count() == len(every)
    late = trade(symbol="S0", price=77.0, trade_id=5, at="2024-01-01 02:00:30")
    land(spark, lake, [late, *hour(2), *hour(55)])
    assert medallion.run_incremental(spark, lake, CLOCK) == 8
    every += [late, *hour(55)]
    same_as_batch(spark, lake, every)
    assert medallion.compact_silver(spark, lake, least_files=1, file_bytes=1 << 30) == ["2024-01-01", "2024-01-02"]
    assert not before & {f for f in stored_files(lake) if "day=1/" in f}    # hidden since the first compaction
    same_as_batch(spark, lake, every)
    assert medallion.run_incremental(spark, lake, CLOCK) is None


def test_a_failed_compaction_changes_nothing(spark, fresh_dir, monkeypatch):
    lake = medallion.LakePaths(fresh_dir)
    for k in (1, 2, 30):
        land(spark, lake, hour(k))
        medallion.run_incremental(spark, lake, CLOCK)
    with monkeypatch.context() as m:
        m.setattr(incremental, "_mark", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            medallion.compact_silver(spark, lake, least_files=1)
    same_as_batch(spark, lake, hour(1) + hour(2) + hour(30))
    land(spark, lake, hour(55))         # another day, under the number of the failed compaction
    medallion.run_incremental(spark, lake, CLOCK)
    same_as_batch(spark, lake, hour(1) + hour(2) + hour(30) + hour(55))
