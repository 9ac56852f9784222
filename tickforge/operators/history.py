"""History copy of silver trades, loaded by day with partition pruning."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge import schemas


def history_rows(silver: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """The six history columns (+ trade_date), optionally for one day.

    On a lake partitioned by year/month/day the day filter becomes a
    partition filter, so only that day's files are listed and read.
    """
    if day is not None:
        d = dt.date.fromisoformat(str(day)) if not isinstance(day, dt.date) else day
        silver = silver.filter((F.col("year") == d.year) & (F.col("month") == d.month)
                               & (F.col("day") == d.day))
    return silver.select(*schemas.HISTORY_COLUMNS,
                         F.to_date("trade_timestamp").alias("trade_date"))


def write_history(rows: DataFrame, path: str, rebalance: bool = False) -> None:
    """Store history rows partitioned by ``trade_date``, replacing only the
    dates present in ``rows`` (dynamic partition overwrite), so re-running a
    day's load does not append a second copy.

    Rows read from the day-partitioned silver lake need no shuffle: every
    input file holds one day, so a task writes at most one file per input
    file it reads, each already sized by the scan split.  Pass
    ``rebalance=True`` for rows that are not clustered by day (the output of
    a shuffle, say); AQE then groups them by day and splits a large day
    over several writers.
    """
    if rebalance:
        rows = rows.hint("rebalance", "trade_date")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("trade_date").parquet(path))


@dataclass
class Scan:
    """``rows`` of all files that can be read; ``faulty``: (file, why not);
    ``shapes``: how many files have each of the schemas found."""
    rows: DataFrame
    faulty: list[tuple[str, str]] = field(default_factory=list)
    shapes: dict[str, int] = field(default_factory=dict)


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Parquet files at any depth under ``root``, by path; only the names are
    read (and sent to the driver, as for any scan)."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(root).select("path"))
    return sorted(r.path for r in found.collect() if "/_" not in r.path[len(root):])


def _one_shape(spark: SparkSession, paths: list[str]) -> tuple[StructType | None, str]:
    """The merged schema of files (their footers are read by a Spark job), or
    why there is none."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema, ""
    except Exception as e:
        return None, str(e).splitlines()[0][:300]


def scan(spark: SparkSession, root: str, target: StructType = schemas.SILVER) -> Scan:
    """All Parquet files under ``root``, whatever their depth, as ``target``.

    Files whose schemas merge are read together.  Where they do not (a column
    has changed its type, a file has no footer), the files in path order are
    halved until what merges is apart from what does not: the cost follows the
    number of places where the schema changes, not the number of files.  Each
    shape is then read with its own schema; columns that it lacks are NULL,
    others are cast (what cannot be cast is NULL), those that ``target`` lacks
    are left out.  A file that cannot be opened is reported, the rest loads.
    """
    todo, groups, faulty = [list_files(spark, root)], [], []
    while todo:
        paths = todo.pop()
        if not paths:
            continue
        shape, why = _one_shape(spark, paths)
        if shape is not None:
            groups.append((shape, paths))
        elif len(paths) == 1:
            faulty.append((paths[0], why))
        else:
            half = len(paths) // 2
            todo += [paths[half:], paths[:half]]
    alike: dict[str, tuple[StructType, list[str]]] = {}
    for shape, paths in groups:
        alike.setdefault(shape.simpleString(), (shape, []))[1].extend(paths)
    rows = spark.createDataFrame([], target)
    for shape, paths in alike.values():
        part = spark.read.schema(shape).parquet(*paths)
        names = {n.lower(): n for n in shape.fieldNames()}
        rows = rows.unionByName(part.select(*[
            (F.col(f"`{names[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in names else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in target.fields]))
    return Scan(rows, sorted(faulty), {k: len(p) for k, (_, p) in alike.items()})
