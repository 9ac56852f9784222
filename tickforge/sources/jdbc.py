"""JDBC table writer (for warehouse tables such as the candle fact)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batchsize: int = 1000,
               num_partitions: int | None = None) -> None:
    """Write ``df`` to ``table``; ``batchsize`` rows per insert batch.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it).
    Needs the database's JDBC driver on the classpath.
    """
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batchsize)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
