"""Stored tables that grow by merges: data in buckets, one commit a load.

    path/data/<load>/bucket=<b>/part-*.parquet   written once, never changed
    path/commits/<number>.json                   which load holds each bucket

A merge reads and rewrites the buckets that its rows fall into and commits a
map in which only those point to its own load; files of other buckets are not
touched.  A commit is a file that must not exist yet, put in place in one step
with its whole content, so of two writers that pick the same number one fails,
reads the newer commit and tries again: it merges anew only if the other has
changed a bucket of its own.  Readers take the newest commit and see a load
wholly or not at all.

``applied`` makes a streaming sink exactly-once: the commit that holds a
micro-batch also holds its number, and a replayed batch is left out.

What the newest ``KEEP`` commits do not hold is deleted, so a reader that has
opened the one before the newest can go on.  Commits are small and stay.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge.sources import files

KEEP = 2
ATTEMPTS = 20
BUCKET = "bucket"
#: Rows without a bucket.
NONE = "none"


@dataclass
class Commit:
    number: int = 0
    buckets: dict[str, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


class BucketTable:
    """``bucket``: a text column of few values (a month, a day), from the
    table's columns; ``schema``: of the stored rows."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, bucket: Column):
        self.spark, self.path, self.schema, self.bucket = spark, path.rstrip("/"), schema, bucket

    # -- reading -------------------------------------------------------------
    def commit(self, number: int | None = None) -> Commit:
        """The newest commit (number 0: none yet), or the one asked for."""
        if number is None:
            number = max([int(n[:-5]) for n in files.names(self.spark, f"{self.path}/commits") if n[:-5].isdigit() and n.endswith(".json")], default=0)
        if number <= 0:
            return Commit()
        return Commit(number, **json.loads(files.read(self.spark, f"{self.path}/commits/{number:010d}.json")))

    def rows(self, commit: Commit | None = None, buckets: list[str] | None = None) -> DataFrame:
        """All rows, or those of some buckets; only their folders are listed."""
        held = (commit or self.commit()).buckets
        wanted = [b for b in held if buckets is None or b in buckets]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{held[b]}/{BUCKET}={b}" for b in wanted])

    # -- writing -------------------------------------------------------------
    def _store(self, rows: DataFrame) -> tuple[str, list[str]]:
        load = uuid.uuid4().hex
        placed = rows.select(*self.schema.fieldNames()).withColumn(BUCKET, F.coalesce(self.bucket, F.lit(NONE)))
        placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{load}")
        return load, sorted(n.split("=", 1)[1] for n in files.names(self.spark, f"{self.path}/data/{load}") if n.startswith(f"{BUCKET}="))

    def _drop(self, load: str, bucket: str | None = None) -> None:
        files.delete(self.spark, f"{self.path}/data/{load}" + (f"/{BUCKET}={bucket}" if bucket else ""))

    def merge(self, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame],
              applied: tuple[str, int] | None = None) -> int:
        """Replace the buckets of ``incoming`` by ``combine(stored rows of these
        buckets, incoming)``; returns the commit's number.  ``applied``: (stream,
        batch number)."""
        if applied and self.commit().applied.get(applied[0], -1) >= applied[1]:
            return self.commit().number
        given, touched = self._store(incoming)  # once, whatever happens below
        if not touched:
            self._drop(given)
            return self.commit().number
        base = load = None
        try:
            for _ in range(ATTEMPTS):
                now = self.commit()
                if applied and now.applied.get(applied[0], -1) >= applied[1]:
                    return now.number
                if base is None or any(now.buckets.get(b) != base.buckets.get(b) for b in touched):
                    if load:
                        self._drop(load)
                    base, rows = now, self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{given}/{BUCKET}={b}" for b in touched])
                    load = None
                    try:
                        load, made = self._store(combine(self.rows(now, touched), rows))
                    except Exception:
                        if self.commit().number < now.number + KEEP:
                            raise
                        base = None  # what it read has been deleted meanwhile
                        continue
                kept = {b: x for b, x in now.buckets.items() if b not in touched}
                state = {"buckets": kept | {b: load for b in made},
                         "applied": now.applied | ({applied[0]: applied[1]} if applied else {})}
                if files.put_if_absent(self.spark, f"{self.path}/commits/{now.number + 1:010d}.json", json.dumps(state)):
                    self._forget(now.number + 1)
                    load = None
                    return now.number + 1
            raise RuntimeError(f"{self.path}: {ATTEMPTS} other loads were committed first")
        finally:
            self._drop(given)
            if load:
                self._drop(load)

    def _forget(self, newest: int) -> None:
        """Delete what the commit before the kept ones held and they do not."""
        if newest <= KEEP:
            return
        old, after = self.commit(newest - KEEP), self.commit(newest - KEEP + 1)
        for b, load in old.buckets.items():
            if after.buckets.get(b) != load:
                self._drop(load, b)
