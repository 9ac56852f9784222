"""Tables stored in an order.

Rows are dealt by ranges of the order's columns (Spark samples the bounds) and
sorted within each range, one file a range.  Spark numbers part files by
partition, so the files in the order of their numbers hold the rows in order,
and the statistics of their row groups overlap only in equal keys: a reader that
wants the newest hours opens the first files.  Without a number of partitions
the ranges follow the size of the data (AQE merges neighbouring ones).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def arranged(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """Rows in ``parts`` ranges (None: by size), each sorted.  A key that many
    rows share stays in one range: add columns that tell them apart."""
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def write_ordered(df: DataFrame, path: str, order: list[Column], parts: int | None = None) -> None:
    arranged(df, order, parts).write.mode("overwrite").parquet(path)


def part_number(file_name: Column) -> Column:
    return F.regexp_extract(file_name, r"^part-(\d+)", 1).cast("long")


def with_position(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The stored rows and each one's place (from 1) in the stored order, from
    its file's number and its place there: no sort of the rows, only of one
    count for each file."""
    rows = spark.read.parquet(path).select("*", part_number(F.col("_metadata.file_name")).alias("_part"),
                                           F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return rows.join(first, "_part").withColumn(name, F.col("_first") + F.col("_row") + 1).drop("_part", "_row", "_first")
