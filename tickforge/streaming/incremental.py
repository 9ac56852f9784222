"""Incremental runs: bronze hours by manifest, silver loads without a stream's
state.

``HourSink`` stores each micro-batch of the bronze stream in a folder of its
own, by hours, and then a manifest that names its days.
``load_silver`` takes the batches that it has not taken yet by looking for the
next number of each run, so no folder that has been loaded is listed again; it
cleans and de-duplicates them, removes what the stored silver has for the same
days, and appends the rest as one load.

De-duplication is against what is stored, not against a stream's state: a
message that is delivered again after any time, or through a new checkpoint,
adds no row.  Within a load the first arrival is kept, between loads the one
that was loaded first.

``compact`` rewrites closed days, whose loads have left many small files, as few
files of about one size.  It is a load of its own that holds the day anew; the
file that marks it as done also hides the day's loads before it, so readers see
either.  The hidden folders are deleted by the compaction after it, and loads
go on as before.

A load is planned before it is written (which batches), written into folders
of its own number, and then marked as done.  After a failure the same plan is
written again over what there is, and readers (``silver_rows``) see loads that
are done only.  One loader works on a lake at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge import config, schemas
from tickforge.operators import silver
from tickforge.sources import files
from tickforge.streaming.sinks import query_id

class HourSink:
    """Folders ``run=<query id>/batch=N/year=/month=/day=/hour=`` under
    ``path``, and ``_manifests/<run>/N.json`` with a batch's days."""

    def __init__(self, path: str, checkpoint: str):
        self.path, self.checkpoint = path.rstrip("/"), checkpoint
        self._run: str | None = None

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        self._run = self._run or query_id(spark, self.checkpoint)
        target, hours = _folder(self.path, self._run, batch_id), schemas.BRONZE_PARTITIONS
        # files are moved once: nobody looks into the folder before its manifest is there
        df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2") \
            .partitionBy(*hours).parquet(target)
        days = [""]
        for c in hours[:3]:
            days = [f"{d}/{n}" for d in days for n in files.names(spark, target + d) if n.startswith(f"{c}=")]
        files.put(spark, f"{self.path}/_manifests/{self._run}/{batch_id:010d}.json", json.dumps(days))


def new_batches(spark: SparkSession, path: str, taken: dict[str, int]) -> dict[str, list[int]]:
    """Batches with a manifest after those taken, {run: numbers}; looks for the
    next numbers only.  There is a folder for each checkpoint of the stream."""
    found = {}
    for run in files.names(spark, f"{path}/_manifests"):
        n = first = taken.get(run, -1) + 1
        while files.exists(spark, f"{path}/_manifests/{run}/{n:010d}.json"):
            n += 1
        if n > first:
            found[run] = list(range(first, n))
    return found


def _folder(path: str, run: str, batch: int) -> str:
    return f"{path}/run={run}/batch={batch}"


def bronze_batches(spark: SparkSession, path: str, batches: dict[str, list[int]]) -> tuple[DataFrame, list[tuple]]:
    """The rows of these batches, read from their folders only, and the days
    they have."""
    folders, days = [], set()
    for run, numbers in batches.items():
        for n in numbers:
            held = json.loads(files.read(spark, f"{path}/_manifests/{run}/{n:010d}.json"))
            days |= {tuple(p.split("=")[1] for p in day.split("/")[1:]) for day in held}
            if held:
                folders.append(_folder(path, run, n))
    if not folders:
        return spark.createDataFrame([], schemas.BRONZE), []
    rows = spark.read.schema(schemas.BRONZE).option("basePath", path).parquet(*folders)
    return rows, sorted(tuple(map(int, d)) for d in days if all(p.isdigit() for p in d))


SILVER_LOADED = StructType([*schemas.SILVER.fields]).add("load", "long")


@dataclass
class Done:
    """The last load that is done, the last batch of each run in it, days whose
    loads up to a number are replaced, and loads that are compactions."""
    number: int = 0
    taken: dict[str, int] = field(default_factory=dict)
    hidden: dict[str, int] = field(default_factory=dict)
    compactions: list[int] = field(default_factory=list)


def done(spark: SparkSession, path: str) -> Done:
    numbers = [int(n[:-5]) for n in files.names(spark, f"{path}/_loads") if n.endswith(".done")]
    if not numbers:
        return Done()
    return Done(max(numbers), **json.loads(files.read(spark, f"{path}/_loads/{max(numbers):010d}.done")))


def _mark(spark: SparkSession, path: str, state: Done) -> None:
    """Commit a load; the newest mark is all that is needed."""
    kept = {k: v for k, v in asdict(state).items() if k != "number"}
    if not files.put_if_absent(spark, f"{path}/_loads/{state.number:010d}.done", json.dumps(kept)):
        raise RuntimeError(f"load {state.number} of {path} is done already: two loaders at once")
    for old in files.names(spark, f"{path}/_loads"):
        if old[:10].isdigit() and int(old[:10]) < state.number:
            files.delete(spark, f"{path}/_loads/{old}")


def _day_folder(path: str, year: int, month: int, day: int) -> str:
    return f"{path}/year={year}/month={month}/day={day}"


def silver_rows(spark: SparkSession, path: str, state: Done | None = None, days: list[tuple] | None = None) -> DataFrame:
    """Rows of the loads that are done, with their load's number; ``days``:
    (year, month, day) to read."""
    state = done(spark, path) if state is None else state
    if not state.number:
        return spark.createDataFrame([], SILVER_LOADED)
    there = [path]
    if days is not None:
        there = [p for d in days if files.exists(spark, p := _day_folder(path, *d))]
        if not there:
            return spark.createDataFrame([], SILVER_LOADED)
    rows = spark.read.schema(SILVER_LOADED).option("basePath", path).parquet(*there).where(F.col("load") <= state.number)
    for day, before in state.hidden.items():
        y, m, d = map(int, day.split("-"))
        rows = rows.where(~((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d) & (F.col("load") <= before)))
    return rows


#: Stands in a plan for a compaction.
COMPACT = "compact"


def _planned(spark: SparkSession, path: str, number: int) -> dict[str, list[int]] | None:
    """The batches of a load that was begun.  What a failed compaction has
    written under its number is deleted."""
    plan = f"{path}/_loads/{number:010d}.plan"
    if not files.exists(spark, plan):
        return None
    held = json.loads(files.read(spark, plan))
    if COMPACT not in held:
        return held
    for day in held[COMPACT]:
        files.delete(spark, f"{_day_folder(path, *day)}/load={number}")
    files.delete(spark, plan)
    return None


def compact(spark: SparkSession, path: str, up_to: int | None = None, open_days: int = 1, least_files: int = 8,
            file_bytes: int = 128 << 20, max_days: int = 31) -> list[str]:
    """Rewrite days that have at least ``least_files`` files of an average size
    below half of ``file_bytes``, except the ``open_days`` newest; at most
    ``max_days`` in a run, the oldest first.  ``up_to``: the last load whose rows
    nobody needs by its number any more (default: all).  Returns the days."""
    state = done(spark, path)
    up_to = state.number if up_to is None else up_to
    if not state.number or up_to < state.number or _planned(spark, path, state.number + 1):
        return []
    for day, before in state.hidden.items():  # readers of the last compaction have had their time
        folder = _day_folder(path, *map(int, day.split("-")))
        for n in files.names(spark, folder):
            if n.startswith("load=") and int(n[5:]) <= before:
                files.delete(spark, f"{folder}/{n}")
    days = [tuple(int(p.split("=")[1]) for p in (y, m, d))
            for y in files.names(spark, path) if y.startswith("year=")
            for m in files.names(spark, f"{path}/{y}") if m.startswith("month=")
            for d in files.names(spark, f"{path}/{y}/{m}") if d.startswith("day=")]
    chosen = []
    for day in sorted(days)[:len(days) - open_days if open_days else None]:
        loads = [n for n in files.names(spark, _day_folder(path, *day)) if n.startswith("load=") and int(n[5:]) <= state.number]
        sizes = [s for n in loads for s in files.sizes(spark, f"{_day_folder(path, *day)}/{n}", ".parquet")]
        if len(sizes) >= least_files and sum(sizes) < len(sizes) * file_bytes / 2 and len(chosen) < max_days:
            chosen.append((day, -(-sum(sizes) // file_bytes)))
    if not chosen:
        return []
    number = state.number + 1
    files.put(spark, f"{path}/_loads/{number:010d}.plan", json.dumps({COMPACT: [day for day, _ in chosen]}))
    parts = None
    for day, n in chosen:  # a day's rows in n files, by time
        rows = silver_rows(spark, path, state, [day]).drop("load")
        rows = rows.repartitionByRange(n, "trade_timestamp", "symbol", "price").sortWithinPartitions("trade_timestamp")
        parts = rows if parts is None else parts.unionByName(rows)
    parts.withColumn("load", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*schemas.SILVER_PARTITIONS, "load").parquet(path)
    names = [f"{y:04d}-{m:02d}-{d:02d}" for (y, m, d), _ in chosen]
    _mark(spark, path, Done(number, state.taken, {d: state.number for d in names}, [*state.compactions, number]))
    return names


def not_stored(incoming: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``stored`` does not have.  The stored
    days are reduced to the incoming keys first, so that a small load is
    broadcast to them (once its size is measured) and they are not shuffled;
    the second join has no more rows than the first found."""
    twice = stored.select(*key).join(incoming.select(*key), key, "left_semi").distinct()
    return incoming.join(twice, key, "left_anti")


def load_silver(spark: SparkSession, bronze: str, path: str, processed_at=None, strict: bool = False) -> int | None:
    """Load the bronze batches that are new; the load's number, None without any."""
    state = done(spark, path)
    number = state.number + 1
    batches = _planned(spark, path, number)  # a load that has failed: the same batches again
    if not batches:
        batches = new_batches(spark, bronze, state.taken)
        if not batches:
            return None
        files.put(spark, f"{path}/_loads/{number:010d}.plan", json.dumps(batches))
    rows, days = bronze_batches(spark, bronze, batches)
    own = f"{path}/_work/{number:010d}"
    fresh = silver.dedupe(silver.normalize(silver.clean(rows, strict)))
    fresh.write.mode("overwrite").parquet(own)  # joined twice: once against the stored days, once against what that finds
    incoming = spark.read.schema(fresh.schema).parquet(own)
    new = not_stored(incoming, silver_rows(spark, path, state, days), config.DEDUPE_KEY)
    out = silver.add_date_parts(silver.enrich(new, processed_at).select(*silver.SILVER_ORDER)) \
        .withColumn("load", F.lit(number).cast("long")).hint("rebalance", *schemas.SILVER_PARTITIONS)
    # what a failed attempt has left of this load has the same folders: same batches, same stored loads
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*schemas.SILVER_PARTITIONS, "load").parquet(path)
    files.delete(spark, own)
    _mark(spark, path, Done(number, state.taken | {r: n[-1] for r, n in batches.items()}, state.hidden, state.compactions))
    return number


def loads_between(spark: SparkSession, path: str, after: int) -> list[int]:
    """Loads with new rows after a number."""
    state = done(spark, path)
    return [n for n in range(after + 1, state.number + 1) if n not in state.compactions]
