"""Line de-duplication against levelled sorted runs of line hashes.

State.  Every line key seen so far is in one run: a table (h1, h2, owner),
bucketed and sorted by the hash, where owner is the smallest id that holds the
key.  A run belongs to a level; when a level has ``fan_out`` runs they are
compacted into one run of the next level.  So a batch is joined with
O(log batches) runs, and a key is rewritten O(log batches) times.

A batch.  Its keys are reduced to their smallest id (combined before the
shuffle, so a line that a third of all documents hold is one row per task),
anti-joined with the runs, and added as a new run.  All lines of a key whose
owner is a smaller id than the document's own are dropped.

A key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z
lower-cased, hashed to 128 bits.  Keys under ``min_chars`` code points are
never dropped.  A null or empty text is one empty line.  Rows with the same id
are one document here (their lines do not drop each other's), null ids come
last and count as one document.  Batches must come in ascending id order.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge.llm.arrowtext import pieces
from tickforge.llm.common import discard, documents, public_id, shuffle_partitions, ship, written
from tickforge.session import run_dir

MIN_CHARS = 10
FAN_OUT = 2
BATCHES = 4
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def _hashes(key):
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, id, version, line): the hashed keys of all lines of (id, text)
    long enough to be dropped; line counts from 0, version tells rows of one
    id with different texts apart."""
    lines = docs.select("id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    key = F.translate(F.btrim("s", F.lit(BLANKS)), UPPER, SMALL)
    return lines.select(key.alias("key"), "id", "version", "line").where(F.length("key") >= min_chars) \
        .select(*_hashes(F.col("key")), "id", "version", "line")


class LineRuns:
    """The runs of one corpus, as bucketed tables in the shared scratch area."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = shuffle_partitions(spark)
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = f"{run_dir(self.spark, 'line-runs')}/{name}"
        rows.repartition(self.buckets, "h1").write.bucketBy(self.buckets, "h1").sortBy("h1", "h2") \
            .option("path", self.paths[name]).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        """Forget the table; its files stay in the scratch folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def all(self) -> DataFrame | None:
        """Every run's rows; each key is in one run only."""
        names = [x for level in self.levels for x in level]
        out = None
        for x in names:
            run = self.spark.table(x)
            out = run if out is None else out.unionByName(run)
        return out

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(x) for level in self.levels for x in level]

    def add(self, keys: DataFrame) -> None:
        """Add a batch's (h1, h2, id) rows: those in no run become a new run."""
        new = keys.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
        for run in self.runs():
            new = new.join(run, ["h1", "h2"], "left_anti")
        self._put(0, self._write(new))

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            old, self.levels[level] = self.levels[level], []
            rows = self.spark.table(old[0])
            for x in old[1:]:
                rows = rows.unionByName(self.spark.table(x))
            merged = self._write(rows)
            for x in old:
                self._drop(x)
            self._put(level + 1, merged)

    def dropped(self, keys: DataFrame) -> DataFrame:
        """(id, version, lines): the lines that a smaller id owns, for documents
        with any.  The runs' files are read as they are, without their buckets:
        both sides are then dealt for the join and a hot line can be split."""
        files = [self.spark.read.schema("h1 long, h2 long, owner long").parquet(self.paths[x])
                 for level in self.levels for x in level]
        parts = [keys.join(run, ["h1", "h2"]).where("owner < id").select("id", "version", "line") for run in files]
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out.groupBy("id", "version").agg(F.sort_array(F.collect_set("line")).alias("lines"))

    def close(self) -> None:
        for level in self.levels:
            for x in level:
                self._drop(x)
        self.levels = []


def without_lines(rows: DataFrame, text_col: str, lines_col: str) -> DataFrame:
    """The rows with kept (the text without the numbered lines), n_lines,
    n_dropped, kept_sha256."""
    ship(rows.sparkSession)
    at, of = rows.columns.index(text_col), rows.columns.index(lines_col)
    names = [*rows.columns, "kept", "n_lines", "n_dropped", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                kept, n, gone = [], [], []
                for text, lines in zip(piece.column(at).to_pylist(), piece.column(of).to_pylist()):
                    text = text or ""
                    own, drop = text.split("\n"), set(lines or ())
                    n.append(len(own))
                    gone.append(len(drop))
                    kept.append("\n".join(x for i, x in enumerate(own) if i not in drop) if drop else text)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string())], names=names)

    schema = StructType(list(rows.schema.fields)).add("kept", "string").add("n_lines", "long").add("n_dropped", "long") \
        .add("kept_sha256", "string")
    return rows.mapInArrow(run, schema)


def batch_bounds(rows: DataFrame, batches: int) -> list[tuple[int, int]]:
    """Id ranges [a, b) with about as many rows each."""
    got = rows.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 10000).alias("c")).first()["c"]
    cuts = sorted(set(got or []))
    edges = [-(1 << 63), *cuts, None]
    return list(zip(edges[:-1], edges[1:]))


def _within(docs: DataFrame, id_col: str, low: int, high: int | None) -> DataFrame:
    """Rows of an id range, by the id column as it is stored, so that the scan
    can skip what lies outside; null ids are in the last range."""
    own = F.col(f"`{id_col}`").cast("long")
    return docs.where((own >= low) | own.isNull() if high is None else (own >= low) & (own < high))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
              batches: int = BATCHES, fan_out: int = FAN_OUT) -> DataFrame:
    """(id, version, lines) of all documents that lose lines, fed batch by batch."""
    rows = documents(docs, id_col, text_col)
    runs = LineRuns(docs.sparkSession, fan_out)
    out = None
    try:
        for low, high in batch_bounds(rows, batches):
            # written once, used for the new run and for the decisions
            batch = documents(_within(docs, id_col, low, high), id_col, text_col)
            keys = written(line_keys(batch, min_chars), "line-keys")
            runs.add(keys)
            gone = written(runs.dropped(keys), "line-drops")
            discard(keys)
            out = gone if out is None else out.unionByName(gone)
    finally:
        runs.close()
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fan_out: int = FAN_OUT) -> DataFrame:
    """(doc_id, kept, n_lines, n_dropped, kept_sha256), one row for each input
    row.  Other columns are ignored; an empty table gives no rows."""
    rows = documents(docs, id_col, text_col)
    gone = decisions(docs, id_col, text_col, min_chars, batches, fan_out)
    out = without_lines(rows.withColumn("version", F.xxhash64("text")).join(gone, ["id", "version"], "left")
                        .select("id", "text", "lines"), "text", "lines")
    return out.select(public_id().alias(id_col), "kept", "n_lines", "n_dropped", "kept_sha256")
