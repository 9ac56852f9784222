from tests.helpers import shuffle_records_written, trade, trades
from tickforge.operators import silver


def test_quality_filter_edges(spark):
    rows = [
        trade(price=0.0),                    # not > 0
        trade(price=999999.99),              # kept
        trade(price=1000000.0),              # not < cap
        trade(price=float("nan")),           # NaN fails < cap
        trade(price=None),
        trade(quantity=0.0),
        trade(quantity=float("nan")),        # NaN quantity passes > 0 (default)
        trade(quantity=float("inf")),        # so does infinity
        trade(symbol=None),
        {**trade(), "trade_time": None},
    ]
    df = trades(spark, rows)
    kept = silver.clean(df).collect()
    assert len(kept) == 3
    assert sorted(r.price for r in kept)[0] == 100.0
    strict = silver.clean(df, strict=True).collect()
    assert [r.price for r in strict] == [999999.99]


def test_enrichment_values(spark):
    rows = [trade(price=100.0, quantity=100.0, side=False),    # value exactly 10000
            trade(price=1000.0, quantity=10.5, side=True, at="2024-01-01 00:00:01"),
            trade(price=2.5, quantity=0.123456789, side=None, at="2024-01-01 00:00:02")]
    out = {r.price: r for r in silver.transform(trades(spark, rows), processed_at="2024-01-01").collect()}
    a, b, c = out[100.0], out[1000.0], out[2.5]
    assert a.trade_value == 10000.0 and a.is_large_trade is False and a.trade_side == "BUY"
    assert b.trade_value == 10500.0 and b.is_large_trade is True and b.trade_side == "SELL"
    assert b.price_magnitude == 3.0 and a.price_magnitude == 2.0
    # NULL side is SELL (upstream semantics), quantity rounded to 8 places
    assert c.trade_side == "SELL" and c.quantity == 0.12345679
    assert c.trade_value == round(2.5 * 0.12345679, 8)
    assert str(a.trade_timestamp) == "2024-01-01 00:00:00"
    assert str(a.ingest_timestamp) == "2024-01-01 00:00:02"


def test_bad_ingest_text_gives_null_not_error(spark):
    rows = [{**trade(), "ingested_at": "not a time"}]
    r = silver.transform(trades(spark, rows)).collect()[0]
    assert r.ingest_timestamp is None


def test_dedupe_keeps_first_arrival_and_collapses_opposite_sides(spark):
    rows = [
        trade(side=True, ingested="2024-01-01T00:00:05", trade_id=2),
        trade(side=False, ingested="2024-01-01T00:00:03", trade_id=1),  # first arrival
        trade(side=False, ingested="2024-01-01T00:00:09", trade_id=1),  # redelivery
        trade(price=101.0, ingested="2024-01-01T00:00:04"),             # other key
    ]
    out = silver.silver_batch(trades(spark, rows), processed_at="2024-01-01")
    got = {r.price: r for r in out.collect()}
    assert len(got) == 2
    assert got[100.0].trade_id == 1 and got[100.0].is_buyer_maker is False
    assert got[100.0].trade_side == "BUY"
    assert (got[100.0].year, got[100.0].month, got[100.0].day) == (2024, 1, 1)


def test_dedupe_missing_ingest_time_sorts_last(spark):
    rows = [{**trade(trade_id=1), "ingested_at": None}, trade(trade_id=2)]
    r = silver.silver_batch(trades(spark, rows)).collect()
    assert len(r) == 1 and r[0].trade_id == 2


def test_dedupe_order_is_exact(spark):
    """Same key and ingest time: the smallest whole id, 1000 before 1024;
    ingest times at the ends of the calendar; no id last."""
    for ids, kept in (((1024, 1000), 1000), ((2**62 + 1, 2**62), 2**62), ((None, 9), 9)):
        r = silver.silver_batch(trades(spark, [trade(trade_id=i) for i in ids])).collect()
        assert [x.trade_id for x in r] == [kept]
    rows = [trade(trade_id=1, ingested="9999-12-31T23:59:59"), trade(trade_id=2, ingested="0001-01-01T00:00:00"),
            trade(trade_id=3)]
    assert [x.trade_id for x in silver.silver_batch(trades(spark, rows)).select("trade_id").collect()] == [2]


def test_sources_do_not_split_a_key(spark):
    rows = [trade(source="a", trade_id=1, ingested="2024-01-01T00:00:05"), trade(source="b", trade_id=2)]
    r = silver.silver_batch(trades(spark, rows)).collect()
    assert [(x.source, x.trade_id) for x in r] == [("b", 2)]


def test_impossible_times_are_null_and_filtered(spark):
    from tickforge.operators import bronze
    rows = [{**trade(trade_id=1), "trade_time": 1_704_067_200_000_000_000}, {**trade(trade_id=2), "trade_time": -2**63},
            trade(trade_id=3)]
    b = {r.trade_id: r for r in bronze.add_time_parts(trades(spark, rows)).collect()}
    assert b[1].timestamp is None and b[2].year is None and b[3].year == 2024
    assert [r.trade_id for r in silver.silver_batch(trades(spark, rows)).collect()] == [3]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """One trade delivered 12,000 times (most of the input) plus 100 distinct
    trades over 4 input partitions: the de-duplication shuffle carries at
    most one row per key per map task, so the hot key never gathers in one
    reducer."""
    hot = [trade(trade_id=7, ingested=f"2024-01-01T00:00:{i % 60:02d}") for i in range(12_000)]
    cold = [trade(price=200.0 + i, trade_id=i) for i in range(100)]
    df = trades(spark, hot + cold).repartition(4)
    out = silver.dedupe(silver.normalize(silver.clean(df)))
    written = shuffle_records_written(out.select("price"))
    assert len(written) == 2                      # the repartition above, then de-duplication
    assert written[0] <= 4 * (1 + 100), written   # the de-duplication shuffle (top of the plan)
    assert out.count() == 101
