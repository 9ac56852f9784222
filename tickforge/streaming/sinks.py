"""Micro-batch sinks for the candle stream.

``BatchFileSink`` makes the gold sink idempotent: each micro-batch is
written with overwrite to a folder of its own, named by the query that
wrote it and the batch, so a batch that is replayed after a failure
replaces its earlier partial output instead of adding a second copy, and
a query started on a new checkpoint never touches what an earlier one
stored.  Readers take the copy written last of each key.  ``JdbcSink``
appends to a table (at-least-once, like any plain JDBC append).  Both
raise on failure: a swallowed error would let the query commit a batch
that was never stored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge import schemas
from tickforge.sources.jdbc import write_jdbc

DATE = "candle_date"


def with_date(candles: DataFrame) -> DataFrame:
    """Candles with the partition column of the stored table."""
    return candles.withColumn(DATE, F.to_date("candle_start_time"))


def clustered(rows: DataFrame, partition_by: list[str], files: int | None, spread_by: list[str],
              tasks: int | None = None) -> DataFrame:
    """Rows dealt so that a micro-batch writes at most ``files`` files into
    each partition folder (None leaves them where they are: every task then
    writes a file into every folder it has rows for).  A folder's rows are
    split by a hash of ``spread_by``, so a hot hour has ``files`` writers.
    ``tasks``: as many writers whatever the size (else AQE gives a small batch
    of many folders to one)."""
    if not files:
        return rows
    salt: Column = F.pmod(F.xxhash64(*spread_by), F.lit(files))
    return rows.repartition(*([tasks] if tasks else []), *[F.col(c) for c in partition_by], salt)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a query's checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


class BatchFileSink:
    """Folders ``run=<query id>/batch_id=N/candle_date=D`` under ``path``.

    The query id is the one Spark keeps in the checkpoint: a restart on the
    same checkpoint continues the same run, a new or emptied checkpoint is a
    new run.  Batches without rows leave no folder.
    """

    def __init__(self, path: str, checkpoint: str | None = None):
        self.path = path.rstrip("/")
        self.checkpoint = checkpoint
        self._run: str | None = None

    def bound(self, checkpoint: str) -> BatchFileSink:
        return BatchFileSink(self.path, checkpoint)

    def run_id(self, spark: SparkSession) -> str:
        if self._run is None:
            if not self.checkpoint:
                raise ValueError("the sink needs its query's checkpoint folder")
            self._run = query_id(spark, self.checkpoint)
        return self._run

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        target = f"{self.path}/run={self.run_id(df.sparkSession)}/batch_id={batch_id}"
        rows = with_date(df).withColumn("written_at", F.current_timestamp()).persist()
        try:
            if not rows.isEmpty():
                rows.write.mode("overwrite").partitionBy(DATE).parquet(target)
        finally:
            rows.unpersist()


def stored_schema(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("written_at", "timestamp").add("run", "string") \
        .add("batch_id", "long").add(DATE, "date")


def read_latest(spark: SparkSession, path: str, key: list[str], schema: StructType = schemas.CANDLE,
                where: Column | None = None) -> DataFrame:
    """Rows of a ``BatchFileSink`` folder, one per key: the copy written last.

    ``where`` may test ``candle_date`` to prune folders.  One ``max`` of a
    struct that starts with the time of writing, so copies are combined on
    the map side and all columns come from the same row.
    """
    raw = spark.read.schema(stored_schema(schema)).parquet(path)
    if where is not None:
        raw = raw.filter(where)
    rest = [c for c in raw.columns if c not in (*key, "written_at", "batch_id", "run")]
    last = F.max(F.struct("written_at", "batch_id", "run", *rest)).alias("_last")
    return raw.groupBy(*key).agg(last).select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest])


class JdbcSink:
    def __init__(self, url: str, table: str, properties: dict | None = None,
                 batchsize: int = 1000, num_partitions: int | None = None):
        self.url, self.table, self.properties = url, table, properties
        self.batchsize, self.num_partitions = batchsize, num_partitions

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        write_jdbc(df, self.url, self.table, self.properties, "append", self.batchsize, self.num_partitions)
