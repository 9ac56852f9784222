import json

from tests.helpers import ms, trade, trades
from tickforge.operators import envelope
from tickforge.plans import medallion
from tickforge.sources.streams import lake_table


def test_cli_runs_stages_in_order(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    rows = [trade(symbol=s, price=100.0 + m, trade_id=m, at=f"2024-01-01 00:{m:02d}:05")
            for m in range(30) for s in ("BTCUSDT", "ETHUSDT")]
    envelope.keyed_json(trades(spark, rows)).write.json(lake.landing)
    docs = f"{fresh_dir}/sentiment_docs"
    doc = {"data": [{"value": "40", "value_classification": "Fear",
                     "timestamp": str(ms("2024-01-01 00:00:00") // 1000)}]}
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(docs)
    medallion.main(["--lake", fresh_dir, "--as-of", "2024-01-01 01:00:00",
                    "--sentiment-docs", docs, "--timeout", "180",
                    "--state-partitions", "3", "--files-per-partition", "2",
                    "--stages", "bronze,silver,gold,sentiment,history,marts", "--day", "2024-01-01"])
    s = spark
    overview = lake_table(s, f"{lake.marts}/mart_market_overview").collect()
    assert sorted(r.symbol for r in overview) == ["BTCUSDT", "ETHUSDT"]
    assert all(r.total_trades_24h == 19 for r in overview)   # windows 00:00-00:18 closed
    pvs = lake_table(s, f"{lake.marts}/mart_price_vs_sentiment").collect()
    assert [(r.symbol, r.fng_value) for r in pvs] == [("BTCUSDT", 40)]
    assert lake_table(s, f"{lake.marts}/mart_pipeline_health").count() == 2
    assert lake_table(s, lake.history).count() == 60
    # the state partition count chosen at the first start is kept in the checkpoint
    state = [p for p in __import__("os").listdir(f"{lake.checkpoint('gold')}/state/0")
             if p.isdigit()]
    assert sorted(state) == ["0", "1", "2"]
