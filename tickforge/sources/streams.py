"""Streaming and batch readers for the message bus and the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MESSAGE_FILE_SCHEMA = "key string, value string"


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   starting_offsets: str = "earliest", fail_on_data_loss: bool = False,
                   min_partitions: int | None = None, max_offsets_per_trigger: int | None = None,
                   extra: dict | None = None) -> DataFrame:
    """Kafka topic as a stream of (key, value, ...) rows.

    Defaults to ``earliest`` so a run-once job started for the first time
    reads the backlog.  ``min_partitions`` splits a topic with few
    partitions into more read tasks; ``max_offsets_per_trigger`` bounds a
    micro-batch when draining a large backlog.  Needs the Kafka connector
    on the classpath.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load()


def message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  archive: str | None = None) -> DataFrame:
    """Landed messages (JSON lines with ``key``/``value`` text) as a stream;
    same columns as the Kafka source, for replay and tests.  ``archive``: a
    folder outside ``path`` that files are moved to once a later batch has been
    planned, so that a trigger lists what is new and the last run's files only."""
    r = spark.readStream.schema(MESSAGE_FILE_SCHEMA)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path)


def lake_stream(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A partitioned parquet lake folder as a stream with a declared schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def lake_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Batch read of a lake folder (honours a stream sink's commit log)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def landed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses, one JSON document per line, as ``value`` text."""
    return spark.read.text(path)
