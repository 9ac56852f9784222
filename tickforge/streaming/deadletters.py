"""Accepted rows and dead letters of the message stream, split in one pass.

Every message of a micro-batch becomes one row, with a reason if it is not
accepted: ``malformed`` (no JSON of a trade), ``bad_time`` (outside the years 1
to 9999), ``quality`` (fails silver's filter) or ``late`` (behind the latest
accepted trade time of the batches before, less ``delay``).  One write stores
both kinds in the batch's folder; then one manifest commits both with their
counts.  A replayed batch replaces its folder, and as its watermark comes from
the manifest of the batch before, it is split the same way: accepted plus
rejected rows are always the rows that came in.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge import config, schemas
from tickforge.operators.bronze import add_time_parts
from tickforge.operators.silver import quality_predicate
from tickforge.sources import files
from tickforge.streaming.sinks import clustered, query_id

_TRADE = [f.name for f in schemas.BRONZE.fields]
SPLIT = StructType([*schemas.BRONZE.fields]).add("key", "string").add("value", "string").add("reason", "string").add("outcome", "string")


def split(messages: DataFrame, late_before: Column | None = None) -> DataFrame:
    """Bronze columns, reason and outcome; rejected rows keep their message."""
    parsed = F.from_json(F.col("value").cast("string"), schemas.TRADE_MESSAGE)
    rows = add_time_parts(messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                                          F.inline(F.array(parsed))))
    reason = F.when(F.col("symbol").isNull() & F.col("trade_time").isNull(), "malformed") \
        .when(F.col("trade_time").isNotNull() & F.col("timestamp").isNull(), "bad_time") \
        .when(~F.coalesce(quality_predicate(), F.lit(False)), "quality")
    if late_before is not None:
        reason = reason.when(F.col("timestamp") < late_before, "late")
    rejected = F.col("reason").isNotNull()
    return rows.withColumn("reason", reason).select(
        *_TRADE, *[F.when(rejected, F.col(c)).alias(c) for c in ("key", "value")], "reason",
        F.when(rejected, "rejected").otherwise("accepted").alias("outcome"))


class SplitSink:
    """Folders ``run=/batch=/outcome=/year=/month=/day=/hour=`` under ``path``;
    ``files``: most files in a folder (None: one for each task with rows of it)."""

    def __init__(self, path: str, checkpoint: str, delay: str = config.WATERMARK_DELAY, files: int | None = None):
        self.path, self.checkpoint, self.delay, self.files = path.rstrip("/"), checkpoint, delay, files

    def manifest(self, run: str, batch: int) -> str:
        return f"{self.path}/_manifests/{run}/{batch:010d}.json"

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        run = query_id(spark, self.checkpoint)
        before = json.loads(files.read(spark, self.manifest(run, batch_id - 1)))["latest"] if batch_id else None
        late = None if before is None else F.timestamp_millis(F.lit(before)) - F.expr(f"INTERVAL {self.delay}")
        seen, accepted = Observation(), F.col("outcome") == "accepted"
        rows = split(messages, late).observe(
            seen, F.count(F.when(accepted, 1)).alias("accepted"), F.count(F.when(~accepted, 1)).alias("rejected"),
            F.max(F.when(accepted, F.col("trade_time"))).alias("latest"))
        folders = ["outcome", *schemas.BRONZE_PARTITIONS]
        rows = clustered(rows, folders, self.files, ["symbol", "trade_time", "price"], spark.sparkContext.defaultParallelism)
        # files are moved once: nobody looks into the folder before its manifest is there
        rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2") \
            .partitionBy(*folders).parquet(f"{self.path}/run={run}/batch={batch_id}")
        got = dict(seen.get)
        got["latest"] = max((x for x in (got["latest"], before) if x is not None), default=None)
        files.put(spark, self.manifest(run, batch_id), json.dumps(got))


def committed(spark: SparkSession, path: str) -> list[tuple[str, int, dict]]:
    """(run, batch, counts) of all committed batches."""
    return [(run, int(n[:-5]), json.loads(files.read(spark, f"{path}/_manifests/{run}/{n}")))
            for run in files.names(spark, f"{path}/_manifests") for n in files.names(spark, f"{path}/_manifests/{run}")]


def stored(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """Accepted or rejected rows of the committed batches."""
    folders = [f"{path}/run={run}/batch={n}/outcome={outcome}" for run, n, counts in committed(spark, path) if counts[outcome]]
    schema = StructType([*SPLIT.fields[:-1]])
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.select(*_TRADE) if outcome == "accepted" else rows.select(*schema.fieldNames())
