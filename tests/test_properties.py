"""Property tests: candles and de-duplication against a brute-force model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import ms, trades
from tickforge.operators import candles, silver

BASE = ms("2024-01-01 00:00:00")

trade_st = st.fixed_dictionaries({
    "source": st.just("feed"),
    "symbol": st.sampled_from(["BTCUSDT", "ETHUSDT", "btcusdt"]),
    "price": st.integers(1, 64 * 50).map(lambda k: k / 64.0),
    "quantity": st.integers(1, 12).map(lambda k: k / 4.0),
    "trade_time": st.integers(0, 3 * 60_000).map(lambda d: BASE + d),
    "is_buyer_maker": st.sampled_from([True, False, None]),
    "ingested_at": st.integers(0, 5).map(lambda s: f"2024-01-01T01:00:0{s}"),
    "trade_id": st.integers(0, 40),
})


def _model(rows, dedupe_tie=lambda i: i):
    """Plain-Python silver de-dup + 1-minute candles.  De-duplication keeps
    the earliest ingest time, then the smallest ``dedupe_tie(trade_id)``;
    candles order by (trade time, trade id)."""
    first = {}
    for r in rows:
        k = (r["symbol"], r["trade_time"], r["price"], r["quantity"])
        order = (r["ingested_at"], dedupe_tie(r["trade_id"]))
        if k not in first or order < first[k][0]:
            first[k] = (order, r)
    kept = [v[1] for v in first.values()]
    groups = {}
    for r in kept:
        groups.setdefault((r["symbol"], r["trade_time"] // 60_000), []).append(r)
    out = {}
    for (sym, minute), g in groups.items():
        g = sorted(g, key=lambda r: (r["trade_time"], r["trade_id"]))
        out[(sym, minute)] = dict(
            open=g[0]["price"], close=g[-1]["price"], high=max(r["price"] for r in g),
            low=min(r["price"] for r in g), volume=sum(r["quantity"] for r in g), count=len(g),
            buy=sum(r["quantity"] for r in g if r["is_buyer_maker"] is False),
            sell=sum(r["quantity"] for r in g if r["is_buyer_maker"] is True))
    return kept, out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trade_st, min_size=1, max_size=40))
def test_candles_match_model(spark, rows):
    _check(spark, rows, lambda i: i)


# Ids that straddle a multiple of 1024 above 2^32.
BIG_ID = 3 * 2**32 + 1000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trade_st.map(lambda r: {**r, "trade_id": BIG_ID + r["trade_id"],
                                         # five distinct milliseconds: many same-ms ties
                                         "trade_time": BASE + (r["trade_time"] % 5) * 20_000}),
                min_size=1, max_size=40))
def test_large_ids_match_model(spark, rows):
    _check(spark, rows, lambda i: i)


def _check(spark, rows, dedupe_tie):
    # unique trade ids per (symbol, ms) keep the model's tie-break well defined
    seen, clean = set(), []
    for r in rows:
        if (r["symbol"], r["trade_time"], r["trade_id"]) not in seen:
            seen.add((r["symbol"], r["trade_time"], r["trade_id"]))
            clean.append(r)
    kept, model = _model(clean, dedupe_tie)
    s = silver.silver_batch(trades(spark, clean), processed_at="2024-01-02")
    assert s.count() == len(kept)
    got = candles.candles(s).collect()
    assert len(got) == len(model)
    epoch = dt.datetime(1970, 1, 1)
    for c in got:
        minute = int((c.candle_start_time - epoch).total_seconds()) // 60
        m = model[(c.symbol, minute)]
        assert (c.open_price, c.close_price, c.high_price, c.low_price) == (
            m["open"], m["close"], m["high"], m["low"])
        assert (c.total_volume, c.trade_count) == (m["volume"], m["count"])
        assert (c.buy_volume_taker, c.sell_volume_maker) == (m["buy"], m["sell"])
        assert c.low_price <= min(c.open_price, c.close_price) <= c.high_price
        assert c.buy_volume_taker + c.sell_volume_maker <= c.total_volume
