import datetime as dt

from pyspark.sql import functions as F

from tickforge import schemas

MSG_COLS = [f.name for f in schemas.TRADE_MESSAGE.fields]


def ms(ts: str) -> int:
    """'2024-01-01 00:00:00.123' (UTC) -> epoch milliseconds."""
    d = dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc)
    return int(round(d.timestamp() * 1000))


def trades(spark, rows):
    """rows: dicts with any of the trade-message fields."""
    full = [tuple(r.get(c) for c in MSG_COLS) for r in rows]
    return spark.createDataFrame(full, schemas.TRADE_MESSAGE)


def trade(symbol="BTCUSDT", price=100.0, quantity=1.0, at="2024-01-01 00:00:00",
          side=False, ingested="2024-01-01T00:00:02", trade_id=None, source="feed"):
    return {"source": source, "symbol": symbol, "price": price, "quantity": quantity,
            "trade_time": ms(at), "is_buyer_maker": side, "ingested_at": ingested,
            "trade_id": trade_id}


def candle_rows(spark, rows):
    """rows: (start 'YYYY-mm-dd HH:MM:SS', symbol, open, high, low, close,
    volume, buy, sell, count)."""
    from tickforge.schemas import CANDLE
    out = []
    for r in rows:
        start = dt.datetime.fromisoformat(r[0])
        out.append((start, *r[1:], dt.datetime(2024, 2, 1)))
    return spark.createDataFrame(out, CANDLE)


def collect_sorted(df, *cols):
    return [r.asDict() for r in df.orderBy(*cols).collect()] if cols else [
        r.asDict() for r in df.collect()]


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


__all__ = ["ms", "trades", "trade", "candle_rows", "collect_sorted", "col_values",
           "shuffle_records_written", "F"]


def shuffle_records_written(df) -> list[int]:
    """Run ``df`` (rows counted in the JVM) and return the records written
    by each shuffle of its final adaptive plan, read from the SQL metrics."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        metrics = node.metrics()
        if name == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            out.append(int(metrics.apply("shuffleRecordsWritten").value()))
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(qe.executedPlan())
    return out
