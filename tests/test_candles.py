from tests.helpers import shuffle_records_written, trade, trades
from tickforge.operators import candles, silver


def _silver(spark, rows):
    return silver.silver_batch(trades(spark, rows), processed_at="2024-01-02")


def test_open_close_tie_break_within_one_millisecond(spark):
    rows = [
        trade(price=10.0, at="2024-01-01 00:00:00.500", trade_id=7),
        trade(price=12.0, at="2024-01-01 00:00:00.500", trade_id=3),   # same ms, lower id: open
        trade(price=11.0, at="2024-01-01 00:00:59.999", trade_id=9),
        trade(price=13.0, at="2024-01-01 00:00:59.999", trade_id=8),   # same ms, lower id
    ]
    c = candles.candles(_silver(spark, rows), ingested_at="2024-01-02").collect()
    assert len(c) == 1
    c = c[0]
    assert (c.open_price, c.close_price, c.high_price, c.low_price) == (12.0, 11.0, 13.0, 10.0)
    assert c.trade_count == 4 and c.total_volume == 4.0


def test_no_trade_id_ties_are_deterministic(spark):
    # same millisecond, no trade id: ordered by price (x 1e8, below 2^37: exact)
    rows = [trade(price=10.0, at="2024-01-01 00:00:00.500"),
            trade(price=12.0, at="2024-01-01 00:00:00.500")]
    for order in (rows, rows[::-1]):
        c = candles.candles(_silver(spark, order)).collect()[0]
        assert (c.open_price, c.close_price) == (10.0, 12.0)


def test_tie_break_is_exact_id_order_for_large_ids(spark):
    # ids that straddle multiples of 1024 and exceed 2^32 in one millisecond
    base = 3 * 2**32 + 1022
    rows = [trade(price=20.0 + k, at="2024-01-01 00:00:30.250", trade_id=base + k)
            for k in range(4)]                                   # ids ...1022 to ...1025
    for order in (rows, rows[::-1]):
        for width in ("1 minute", "1 hour"):
            c = candles.candles(_silver(spark, order), width).collect()[0]
            assert (c.open_price, c.close_price) == (20.0, 23.0)


def test_order_is_exact_for_any_id_and_price(spark):
    """Ids past 2^31 and 2^62 in hourly candles; without ids, prices past
    1374 in one millisecond; a trade without an id comes after those with one."""
    at = "2024-01-01 00:30:00.250"
    for ids in ((2**31 - 1, 2**31), (2**62, 2**62 + 1), (-5, 3)):
        rows = [trade(price=1.0 + k, at=at, trade_id=i) for k, i in enumerate(ids)]
        c = candles.candles(_silver(spark, rows[::-1]), "1 hour").collect()[0]
        assert (c.open_price, c.close_price) == (1.0, 2.0)
    rows = [trade(price=p, at=at) for p in (1375.0, 1374.0, 99_999.5)]
    c = candles.candles(_silver(spark, rows)).collect()[0]
    assert (c.open_price, c.close_price) == (1374.0, 99_999.5)
    rows = [trade(price=1.0, at=at), trade(price=2.0, at=at, trade_id=7)]
    c = candles.candles(_silver(spark, rows)).collect()[0]
    assert (c.open_price, c.close_price) == (2.0, 1.0)


def test_null_side_counts_in_total_only(spark):
    rows = [trade(side=None, quantity=2.0), trade(side=None, quantity=0.5, at="2024-01-01 00:00:10")]
    c = candles.candles(_silver(spark, rows)).collect()[0]
    assert c.buy_volume_taker == 0.0 and c.sell_volume_maker == 0.0 and c.total_volume == 2.5


def test_window_edges(spark):
    rows = [trade(at="2024-01-01 00:00:59.999"), trade(at="2024-01-01 00:01:00.000", price=101.0)]
    c = candles.candles(_silver(spark, rows)).orderBy("candle_start_time").collect()
    assert [str(r.candle_start_time) for r in c] == ["2024-01-01 00:00:00", "2024-01-01 00:01:00"]
    h = candles.candles(_silver(spark, rows), "1 hour").collect()
    assert len(h) == 1 and h[0].trade_count == 2


def test_volume_invariant_and_columns(spark):
    rows = [trade(side=True, quantity=1.0), trade(side=False, quantity=2.0, at="2024-01-01 00:00:01"),
            trade(side=None, quantity=4.0, at="2024-01-01 00:00:02")]
    df = candles.candles(_silver(spark, rows), ingested_at="2024-01-02")
    assert df.columns == ["candle_start_time", "symbol", "open_price", "high_price", "low_price",
                          "close_price", "total_volume", "buy_volume_taker", "sell_volume_maker",
                          "trade_count", "ingested_at"]
    c = df.collect()[0]
    assert c.buy_volume_taker == 2.0 and c.sell_volume_maker == 1.0 and c.total_volume == 7.0


def test_symbols_are_case_sensitive_groups(spark):
    rows = [trade(symbol="BTCUSDT"), trade(symbol="btcusdt")]
    assert candles.candles(_silver(spark, rows)).count() == 2


def test_hot_symbol_is_combined_before_the_shuffle(spark):
    """A symbol with most of the trades, all in two minutes, over 4 input
    partitions: the candle shuffle carries one partial candle per window
    per map task, not the trades."""
    rows = [trade(price=100.0 + i % 50, at=f"2024-01-01 00:0{i % 2}:{i % 60:02d}", trade_id=i)
            for i in range(8_000)]
    rows += [trade(symbol="ETHUSDT", trade_id=i) for i in range(10)]
    df = silver.normalize(silver.clean(trades(spark, rows).repartition(4)))
    written = shuffle_records_written(candles.candles(df))
    assert written[0] <= 4 * 3, written      # (BTC, minute 0), (BTC, minute 1), (ETH, minute 0)
    got = {(r.symbol, r.candle_start_time.minute): r.trade_count
           for r in candles.candles(df).collect()}
    assert got == {("BTCUSDT", 0): 4_000, ("BTCUSDT", 1): 4_000, ("ETHUSDT", 0): 10}
