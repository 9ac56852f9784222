import json

from tests.helpers import trade, trades
from tickforge import config
from tickforge.operators import bronze, envelope


def _raw(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_normalize_envelopes_drops_bad_messages(spark):
    good = {"stream": "btcusdt@aggTrade",
            "data": {"e": "aggTrade", "s": "BTCUSDT", "p": "42000.5", "q": "0.25",
                     "T": 1704067200123, "m": True, "a": 5}}
    numeric = {"stream": "x", "data": {"s": "ETHUSDT", "p": 2300.25, "q": 1, "T": 1, "m": False}}
    texts = [
        json.dumps(good),
        json.dumps(numeric),                                     # numbers instead of text: ok
        "{not json",                                             # malformed
        json.dumps({"result": None, "id": 1}),                   # no data
        json.dumps({"data": {"s": "BTCUSDT", "q": "1", "T": 1, "m": True}}),   # missing p
        json.dumps({"data": {"s": "BTCUSDT", "p": "abc", "q": "1", "T": 1, "m": True}}),  # bad p
        json.dumps({"data": {"s": "BTCUSDT", "p": "1", "q": "1", "T": 1}}),    # side absent
    ]
    raw = _raw(spark, texts)
    out = envelope.normalize_envelopes(raw, ingested_at="2024-01-01T00:00:00")
    rows = {r.symbol + str(r.trade_time): r for r in out.collect()}
    assert len(rows) == 2
    r = rows["BTCUSDT1704067200123"]
    assert (r.price, r.quantity, r.is_buyer_maker, r.trade_id, r.source) == (
        42000.5, 0.25, True, 5, config.SOURCE_TAG)
    assert rows["ETHUSDT1"].price == 2300.25
    flagged = envelope.normalize_envelopes(raw, keep_rejects=True)
    assert flagged.filter("not _valid").count() == 5
    counts = envelope.count_rejects(raw).collect()[0]
    assert (counts.accepted, counts.rejected) == (2, 5)


def test_null_fields_are_kept_and_missing_ones_dropped(spark):
    base = {"s": "BTCUSDT", "p": "1", "q": "1", "T": 5, "m": True}
    texts = [json.dumps({"data": {**base, k: None}}) for k in "sTm"]
    texts += [json.dumps({"data": {k: v for k, v in base.items() if k != gone}}) for gone in base]
    out = envelope.normalize_envelopes(_raw(spark, texts), ingested_at="x").collect()
    assert sorted((r.symbol is None, r.trade_time is None, r.is_buyer_maker is None) for r in out) == [
        (False, False, True), (False, True, False), (True, False, False)]


def test_keyed_json_round_trip_through_bronze(spark):
    df = trades(spark, [trade(side=None, trade_id=3), trade(symbol="ETHUSDT", price=0.015625)])
    kj = envelope.keyed_json(df)
    assert kj.columns == ["key", "value"]
    first = json.loads(kj.filter("key = 'BTCUSDT'").collect()[0].value)
    assert first["is_buyer_maker"] is None and first["trade_id"] == 3   # nulls written
    b = bronze.bronze_from_messages(kj)
    got = {r.symbol: r for r in b.collect()}
    assert got["ETHUSDT"].price == 0.015625
    assert (got["BTCUSDT"].year, got["BTCUSDT"].month, got["BTCUSDT"].day, got["BTCUSDT"].hour) == (
        2024, 1, 1, 0)
    assert str(got["BTCUSDT"].timestamp) == "2024-01-01 00:00:00"


def test_bronze_keeps_malformed_as_null_row(spark):
    df = bronze.bronze_from_messages(_raw(spark, ["garbage", None]))
    b = df.collect()
    assert len(b) == 2
    assert all(r.symbol is None and r.year is None for r in b)
    assert bronze.count_unparsed(df).collect()[0].unparsed == 2


def test_envelope_parses_json_once(spark):
    out = envelope.normalize_envelopes(_raw(spark, ["{}"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
