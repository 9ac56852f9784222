import datetime as dt

from tests.helpers import candle_rows
from tickforge.operators import marts

# (start, symbol, open, high, low, close, volume, buy, sell, count)


def test_ohlc_features_and_hourly_figures(spark):
    c = candle_rows(spark, [
        ("2024-01-01 10:00:00", "BTCUSDT", 100.0, 110.0, 90.0, 100.0, 4.0, 1.0, 3.0, 2),   # open = close
        ("2024-01-01 10:05:00", "BTCUSDT", 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1),          # open 0, vol 0
        ("2024-01-01 10:59:00", "BTCUSDT", 102.0, 120.0, 95.0, 99.0, 2.0, 2.0, 0.0, 3),
        ("2024-01-01 11:00:00", "BTCUSDT", 50.0, 60.0, 40.0, 55.0, 1.0, 0.5, 0.5, 1),
    ])
    rows = {r.candle_start_time: r for r in marts.ohlc_summary(c).collect()}
    a = rows[dt.datetime(2024, 1, 1, 10, 0)]
    assert a.candle_type == "Bullish" and a.body_size_pct == 0.0 and a.buy_pressure_pct == 25.0
    assert a.hour_of_day == 10 and a.candle_hour == dt.datetime(2024, 1, 1, 10)
    assert a.candle_date == dt.datetime(2024, 1, 1)
    assert (a.hourly_open, a.hourly_close, a.hourly_high, a.hourly_low) == (100.0, 99.0, 120.0, 0.0)
    assert (a.hourly_volume, a.hourly_buy_vol, a.hourly_trades, a.hourly_buy_pct) == (6.0, 3.0, 6, 50.0)
    b = rows[dt.datetime(2024, 1, 1, 10, 5)]
    assert b.body_size_pct is None and b.buy_pressure_pct is None
    d = rows[dt.datetime(2024, 1, 1, 10, 59)]
    assert d.candle_type == "Bearish" and d.body_size_pct == round(3 / 102 * 100, 4)
    e = rows[dt.datetime(2024, 1, 1, 11, 0)]
    assert e.hourly_open == 50.0 and e.hourly_trades == 1


def test_ohlc_null_symbol_gets_no_hourly_figures(spark):
    c = candle_rows(spark, [("2024-01-01 10:00:00", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1)])
    r = marts.ohlc_summary(c).collect()[0]
    assert r.hourly_open is None and r.hourly_trades is None and r.hourly_buy_pct is None


def test_market_overview(spark):
    c = candle_rows(spark, [
        ("2024-01-01 00:00:00", "BTCUSDT", 90.0, 95.0, 85.0, 91.0, 1.0, 1.0, 0.0, 1),   # before window
        ("2024-01-02 00:00:00", "BTCUSDT", 100.0, 130.0, 80.0, 105.0, 4.0, 1.0, 3.0, 5),  # first in 24h
        ("2024-01-02 12:00:00", "BTCUSDT", 105.0, 120.0, 99.0, 110.0, 4.0, 3.0, 1.0, 7),  # latest
        ("2024-01-01 12:00:00", "ETHUSDT", 10.0, 11.0, 9.0, 10.5, 1.0, 1.0, 0.0, 1),      # no 24h candle
    ])
    out = marts.market_overview(c, "2024-01-03 00:00:00").collect()
    assert [r.symbol for r in out] == ["BTCUSDT"]
    r = out[0]
    assert (r.current_price, r.open_price_24h, r.high_24h, r.low_24h) == (110.0, 100.0, 130.0, 80.0)
    assert r.price_change_24h == 10.0 and r.price_change_pct_24h == 10.0
    assert (r.volume_24h, r.buy_volume_24h, r.sell_volume_24h, r.buy_ratio_pct) == (8.0, 4.0, 4.0, 50.0)
    assert r.total_trades_24h == 12 and r.last_updated == dt.datetime(2024, 1, 2, 12)
    # the window start is inclusive
    assert marts.market_overview(c, "2024-01-03 00:00:00", window="36 hours").count() == 2


def test_pipeline_health(spark):
    rows = [(f"2024-01-01 10:{m:02d}:00", "BTCUSDT", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 2)
            for m in range(60)]
    rows.append(("2024-01-01 10:59:00", "BTCUSDT", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 2))  # duplicate
    rows.append(("2024-01-01 11:55:00", "ETHUSDT", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 3))
    rows.append(("2024-01-01 11:50:00", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 3))
    c = candle_rows(spark, rows)
    out = marts.pipeline_health(c, "2024-01-01 12:00:00").collect()
    # ordered by hour desc, symbol asc (NULL last)
    assert [(r.ingestion_hour.hour, r.symbol) for r in out] == [(11, "ETHUSDT"), (11, None), (10, "BTCUSDT")]
    btc = out[2]
    assert btc.candles_count == 61 and btc.missing_candles == -1 and btc.completeness_pct == 101.7
    assert btc.total_trades == 122 and btc.latest_candle == dt.datetime(2024, 1, 1, 10, 59)
    assert btc.minutes_since_last_candle == 61.0 and btc.freshness_status == "Dead"
    eth = out[0]
    assert eth.minutes_since_last_candle == 5.0 and eth.freshness_status == "Fresh"   # boundary
    assert eth.day_total_candles == 63 and eth.day_active_symbols == 2
    assert eth.daily_completeness_pct == round(63 / (2 * 1440) * 100, 1)
    nul = out[1]
    assert nul.latest_candle_time is None and nul.freshness_status is None
    stale = marts.pipeline_health(c, "2024-01-01 12:20:00").collect()[0]   # 25 min
    assert stale.freshness_status == "Stale"


def test_pipeline_health_from_a_stored_hourly_table(spark, fresh_dir):
    c = candle_rows(spark, [(f"2024-01-0{d} 10:0{m}:00", s, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 2)
                            for d in (1, 2) for m in (0, 1) for s in ("BTCUSDT", "ETHUSDT")])
    marts.hourly_ingestion(c).write.parquet(fresh_dir)
    at = "2024-01-03 00:00:00"
    stored = marts.pipeline_health(c, at, hourly=spark.read.parquet(fresh_dir))
    assert stored.collect() == marts.pipeline_health(c, at).collect()
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan                       # the candles are not read again


def test_overview_null_symbol_has_no_joined_prices(spark):
    c = candle_rows(spark, [("2024-01-02 10:00:00", None, 1.0, 2.0, 1.0, 1.0, 3.0, 1.0, 0.0, 1)])
    r = marts.market_overview(c, "2024-01-03 00:00:00").collect()[0]
    assert r.current_price is None and r.open_price_24h is None and r.last_updated is None
    assert (r.high_24h, r.volume_24h) == (2.0, 3.0)


def test_overview_prunes_stored_candles(spark, fresh_dir):
    from tickforge.streaming.sinks import with_date
    c = candle_rows(spark, [(f"2024-01-{d:02d} 10:00:00", "BTCUSDT", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1)
                            for d in range(1, 20)])
    with_date(c).write.partitionBy("candle_date").parquet(fresh_dir)
    df = marts.market_overview(spark.read.parquet(fresh_dir), "2024-01-19 12:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(candle_date" in plan and "GreaterThanOrEqual(candle_start_time" in plan
    assert df.collect()[0].total_trades_24h == 1


def test_price_vs_sentiment(spark):
    c = candle_rows(spark, [
        ("2024-01-01 10:00:00", "BTCUSDT", 1.0, 4.0, 1.0, 2.0, 1.0, 1.0, 0.0, 1),
        ("2024-01-01 11:00:00", "BTCUSDT", 1.0, 3.0, 0.5, 4.0, 2.0, 1.0, 0.0, 1),
        ("2024-01-01 11:00:00", "btcusdt", 1.0, 3.0, 0.5, 4.0, 2.0, 1.0, 0.0, 1),
        ("2024-01-02 11:00:00", "BTCUSDT", 1.0, 3.0, 0.5, 4.0, 2.0, 1.0, 0.0, 1),
        ("2024-01-01 11:00:00", "ETHUSDT", 1.0, 3.0, 0.5, 4.0, 2.0, 1.0, 0.0, 1),
    ])
    sent = spark.createDataFrame([("2024-01-01", 40, "Fear")], "date string, fng_value int, fng_classification string")
    out = marts.price_vs_sentiment(c, sent).collect()
    assert [(str(r.date), r.symbol) for r in out][0][0] == "2024-01-02"        # date desc
    got = {(str(r.date), r.symbol): r for r in out}
    assert set(got) == {("2024-01-01", "BTCUSDT"), ("2024-01-01", "BTC"), ("2024-01-02", "BTCUSDT")}
    a = got[("2024-01-01", "BTCUSDT")]
    assert (a.avg_price, a.max_price, a.min_price, a.total_volume) == (3.0, 4.0, 0.5, 3.0)
    assert (a.fng_value, a.fng_classification) == (40, "Fear")
    assert got[("2024-01-02", "BTCUSDT")].fng_value is None


def test_repeated_sentiment_dates_make_one_row(spark):
    c = candle_rows(spark, [("2024-01-01 10:00:00", "BTCUSDT", 1.0, 2.0, 0.5, 1.5, 1.0, 1.0, 0.0, 1)])
    sent = spark.createDataFrame([(dt.date(2024, 1, 1), v, "x", dt.datetime(2024, 1, d)) for v, d in ((40, 2), (41, 3))],
                                 "date date, fng_value int, fng_classification string, updated_at timestamp")
    df = marts.price_vs_sentiment(c, sent)
    assert [r.fng_value for r in df.collect()] == [41]
    # no broadcast from an estimate
    assert "Broadcast" not in df._jdf.queryExecution().sparkPlan().toString()
