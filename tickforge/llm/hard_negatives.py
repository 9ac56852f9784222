"""Hard negatives by inner product, from Hilbert-ordered blocks with zone maps.

For each anchor row: its positives are its first ``n_pos`` other rows of the
same label, by greater score (integer inner product), then smaller id.  For
each positive: the first ``n_neg`` rows of other labels whose score lies in the
window [low, 1] times the positive's score, in the same order.

1. Layout.  Rows are ordered along a Hilbert curve through a grid of four cells
   in each dimension (from a bounded sample; it decides about the order only) and
   stored as Parquet rows of ``BLOCK`` vectors each.  A block's zone map has
   the minimum and maximum of every dimension, its smallest id, and its labels.
2. Bounds.  For an anchor a, sum(max(a_d * lo_d, a_d * hi_d)) and the same with
   min bound all scores of a block (interval arithmetic).
3. Each phase reads the anchor's own block first.  The last of the rows that it
   finds is the limit; the other blocks are read only if their upper bound
   reaches it (for equal scores: only with a smaller id), their lower bound is
   not above the window, and they have a fitting label.  So all rows that can
   be among the first are read, and the result is exact.
4. A block that several anchors must read is read once for each chunk of
   ``CHUNK`` neighbouring anchors; a task sends back the first rows of each
   anchor and window, which are merged by (anchor, window).

Zone maps go to the anchor chunks in pages of ``PAGE`` blocks.  Memory of a task
is a chunk of anchors with a block or a page.  Nothing grows with the data on
the driver.  A group of copies that holds a third of all rows fills blocks with
one point each; of these only those with smaller ids than the limit's are read.

Rows with a null label or vector or with a null or non-finite component, or of
another length than most, take no part.  Components beyond +-2^26 count as
that.  Null ids come after all others and stay null; equal rows under one id
are rows like others, and each is an anchor by itself if the id is one.  Other
columns are not read.  Without anchors, positives or negatives there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import LAST_ID, public_id, ship, shuffle_partitions, written

BLOCK, CHUNK, PAGE = 512, 256, 1024
#: Rows whose range places the curve's grid.
SAMPLE = 1 << 14
LARGEST = 1 << 26
#: Beyond all scores.
FAR = 1 << 62

BLOCKS = "block long, ids binary, labels binary, marks binary, rows binary, lo binary, hi binary, least long, kinds binary"
PAGES = "page int, blocks binary, leasts binary, los binary, his binary, kinds binary, n_kinds binary"
CHUNKS = "chunk long, keys binary, ids binary, labels binary, rows binary"
HITS = "anchor long, anchor_id long, upper long, score long, id long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Keys (rows of bytes, in the curve's order) of points with ``bits`` bits
    in each dimension: Skilling's transform, all points at once."""
    x = cells.T.astype(np.uint32).copy()
    dims = len(x)
    top = np.uint32(1 << (bits - 1))
    q = top
    while q > 1:
        below = np.uint32(q - 1)
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(high, below, swap).astype(np.uint32)
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, np.uint32(q - 1), 0).astype(np.uint32)
        q >>= np.uint32(1)
    x ^= turn
    planes = np.stack([(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)])  # bit, dimension, point
    return np.packbits(planes.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) possible score of each anchor in each block."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return dot(up, lo) + dot(down, hi), dot(up, hi) + dot(down, lo)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows; by floating point where that is exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _matrix(value: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(value, np.int32).reshape(rows, -1).astype(np.int64)


def _ids(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def _keys(cuts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1)
            cells = sum((vecs > c).astype(np.uint8) for c in cuts)
            keys = hilbert(cells, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([k.tobytes() for k in keys], pa.binary())], names=[*batch.schema.names, "curve"])
    return run


def _stored(size: int):
    """Blocks of ``size`` rows from a partition in the curve's order."""

    def block(part: int, number: int, table: pa.Table) -> pa.RecordBatch:
        vecs = table.column("vec").combine_chunks().flatten().to_numpy().reshape(len(table), -1).astype(np.int32)
        ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        return pa.RecordBatch.from_pydict({
            "block": [part << 32 | number], "ids": [ids.tobytes()], "labels": [labels.tobytes()],
            "marks": [np.packbits(table.column("anchor").to_numpy()).tobytes()], "rows": [vecs.tobytes()],
            "lo": [vecs.min(0).tobytes()], "hi": [vecs.max(0).tobytes()], "least": [int(ids.min())],
            "kinds": [np.unique(labels).tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, more]) if held is not None else more
            while len(held) >= size:
                yield block(part, number, held.slice(0, size))
                held, number = held.slice(size), number + 1
        if held is not None and len(held):
            yield block(part, number, held)
    return run


def _anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of blocks; an anchor's key is its block and its place there."""
    for batch in batches:
        for r in batch.to_pylist():
            ids = _ids(r["ids"])
            at = np.flatnonzero(np.unpackbits(np.frombuffer(r["marks"], np.uint8), count=len(ids)))
            rows = np.frombuffer(r["rows"], np.int32).reshape(len(ids), -1)[at]
            yield pa.RecordBatch.from_pydict({
                "key": (r["block"] << 10) + at, "id": ids[at], "label": _ids(r["labels"])[at],
                "vec": pa.array([x.tobytes() for x in rows], pa.binary())})


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for k in range(0, batch.num_rows, CHUNK):
            some = batch.slice(k, CHUNK)
            yield pa.RecordBatch.from_pydict({
                "chunk": [part << 32 | number], "keys": [some.column("key").to_numpy().tobytes()],
                "ids": [some.column("id").to_numpy().tobytes()], "labels": [some.column("label").to_numpy().tobytes()],
                "rows": [b"".join(some.column("vec").to_pylist())]})
            number += 1


def _everything(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A window without bounds for each anchor."""
    for batch in batches:
        for r in batch.select(["chunk", "keys"]).to_pylist():
            keys = _ids(r["keys"])
            yield pa.RecordBatch.from_pydict({"chunk": np.full(len(keys), r["chunk"]), "anchor": keys,
                                              "lower": np.full(len(keys), -FAR), "upper": np.full(len(keys), FAR)})


class Windows:
    """What a chunk's anchors look for: rows (anchor, lower, upper, limit,
    limit_id) of int64; scores from lower to upper, and after the limit's row
    in the order only what comes before it."""

    def __init__(self, value: bytes):
        self.anchor, self.lower, self.upper, self.limit, self.limit_id = np.frombuffer(value, np.int64).reshape(-1, 5).T

    @staticmethod
    def packed(*columns: np.ndarray) -> bytes:
        return np.stack(columns, 1).astype(np.int64).tobytes()


def _chosen(same: bool):
    """Of a chunk's windows and a page of zone maps: (chunk, block, which
    windows must read it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, labels = _ids(r["keys"]), _ids(r["labels"])
                want = Windows(r["windows"])
                anchors = _matrix(r["rows"], len(keys))
                blocks = _ids(r["blocks"])
                low, high = bounds(anchors, _matrix(r["los"], len(blocks)), _matrix(r["his"], len(blocks)))
                at, n_kinds = np.searchsorted(keys, want.anchor), np.frombuffer(r["n_kinds"], np.int64)
                kinds, of = _ids(r["kinds"]), np.repeat(np.arange(len(blocks)), n_kinds)
                has = np.zeros((len(keys), len(blocks)), bool)
                for label in np.unique(labels):
                    has[np.ix_(labels == label, of[kinds == label])] = True
                fits = has[at] if same else (~has | (n_kinds > 1)[None, :])[at]
                reach = np.maximum(want.lower, want.limit)[:, None]
                fits &= (high[at] >= reach) & (low[at] <= want.upper[:, None])
                # a block that only reaches the limit must have a smaller id
                fits &= (high[at] > want.limit[:, None]) | (_ids(r["leasts"])[None, :] < want.limit_id[:, None])
                fits &= (want.anchor >> 10)[:, None] != blocks[None, :]  # has been read
                some = np.flatnonzero(fits.any(0))
                if len(some):
                    yield pa.RecordBatch.from_pydict({
                        "chunk": [r["chunk"]] * len(some), "block": blocks[some],
                        "marks": [np.packbits(fits[:, b]).tobytes() for b in some]})
    return run


def _read(same: bool, first: int):
    """The first rows of each marked window in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, ids, labels = _ids(r["keys"]), _ids(r["ids"]), _ids(r["labels"])
                want = Windows(r["windows"])
                marked = np.flatnonzero(np.unpackbits(np.frombuffer(r["marks"], np.uint8), count=len(want.anchor)))
                others, kinds = _ids(r["b_ids"]), _ids(r["b_labels"])
                own, of = np.unique(np.searchsorted(keys, want.anchor[marked]), return_inverse=True)
                scores = dot(_matrix(r["rows"], len(keys))[own], _matrix(r["b_rows"], len(others)))
                place = keys[own] - (r["block"] << 10)  # of anchors of this block
                may = (labels[own][:, None] == kinds[None, :]) == same
                here = np.flatnonzero((place >= 0) & (place < len(others)))
                may[here, place[here]] = False
                lower = np.maximum(want.lower, want.limit)[marked]
                good = may[of] & (scores[of] >= lower[:, None]) & (scores[of] <= want.upper[marked][:, None])
                w, b = np.nonzero(good)
                score = scores[of[w], b]
                order = np.lexsort([others[b], -score, w])
                w, b, score = w[order], b[order], score[order]
                starts = np.searchsorted(w, np.arange(len(marked)))
                few = np.arange(len(w)) - starts[w] < first
                w, b, score = w[few], b[few], score[few]
                if len(w):
                    window = marked[w]
                    yield pa.RecordBatch.from_pydict({
                        "anchor": want.anchor[window], "anchor_id": ids[own][of[w]], "upper": want.upper[window],
                        "score": score, "id": others[b]})
    return run


def _first(hits: DataFrame, n: int) -> DataFrame:
    """The first rows of each (anchor, window), ranked."""
    order = Window.partitionBy("anchor", "upper").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _search(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, pages: DataFrame, n_pages: int, same: bool,
            first: int, label: str) -> DataFrame:
    """First rows of each window (anchor, lower, upper): own blocks, then all
    that can have more."""

    def gathered(rows: DataFrame) -> DataFrame:
        """Windows with the chunks of their anchors: a chunk's are at most CHUNK times the positives."""
        packed = rows.groupBy("chunk").applyInArrow(_packed_windows, "chunk long, windows binary")
        return anchors.join(packed, "chunk")

    def read(asked: DataFrame) -> DataFrame:
        stored = blocks.select("block", F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"), F.col("rows").alias("b_rows"))
        return asked.join(stored, "block").mapInArrow(_read(same, first), HITS)

    nothing = F.lit(-FAR).cast("long")
    seeds = gathered(windows.select("*", nothing.alias("limit"), F.lit(LAST_ID).alias("limit_id")))
    own = seeds.mapInArrow(_own_blocks, "chunk long, block long, marks binary")
    near = written(read(seeds.join(own, "chunk")), f"{label}-near")
    ranked = _first(near, first)
    last = ranked.where(F.col("rank") == first).select("anchor", "upper", F.col("score").alias("limit"), F.col("id").alias("limit_id"))
    limited = windows.join(last, ["anchor", "upper"], "left").select(
        "chunk", "anchor", "lower", "upper", F.coalesce("limit", nothing).alias("limit"),
        F.coalesce("limit_id", F.lit(LAST_ID)).alias("limit_id"))
    sought = written(gathered(limited), f"{label}-windows")
    asked = sought.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1)))).join(pages, "page") \
        .mapInArrow(_chosen(same), "chunk long, block long, marks binary")
    asked = written(asked, f"{label}-blocks")
    far = written(read(asked.join(sought, "chunk")), f"{label}-far")
    return written(_first(near.unionByName(far), first), f"{label}-first")


def _packed_windows(key, rows):
    columns = [rows.column(c).to_numpy() for c in ("anchor", "lower", "upper", "limit", "limit_id")]
    order = np.lexsort([columns[2], columns[0]])
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()),
                     "windows": pa.array([Windows.packed(*[c[order] for c in columns])], pa.binary())})


def _own_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.select(["chunk", "windows"]).to_pylist():
            own = Windows(r["windows"]).anchor >> 10
            blocks = np.unique(own)
            yield pa.RecordBatch.from_pydict({"chunk": [r["chunk"]] * len(blocks), "block": blocks,
                                              "marks": [np.packbits(own == b).tobytes() for b in blocks]})


def _paged(key, rows):
    kinds = rows.column("kinds").to_pylist()
    joined = {f"{c}s": [b"".join(rows.column(c).to_pylist())] for c in ("lo", "hi")}
    return pa.table({"page": pa.array([key[0].as_py()], pa.int32()), "blocks": [rows.column("block").to_numpy().tobytes()],
                     "leasts": [rows.column("least").to_numpy().tobytes()], **joined, "kinds": [b"".join(kinds)],
                     "n_kinds": [np.array([len(k) // 8 for k in kinds], np.int64).tobytes()]})


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vec",
         n_pos: int = 5, n_neg: int = 5, low: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).  ``vec``: arrays of integers; ``is_anchor``: a test of the
    input's columns; ``low``: the window's lower end as a fraction."""
    spark = rows.sparkSession
    ship(spark)
    vec = F.transform(F.col(f"`{vector_col}`"), lambda x: F.when(
        x.isNotNull(), F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x))).cast("int"))
    taken = rows.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
                        F.col(f"`{label_col}`").cast("long").alias("label"), vec.alias("vec"),
                        F.coalesce(is_anchor, F.lit(False)).alias("anchor")) \
        .where("label is not null and vec is not null and size(vec) > 0 and forall(vec, x -> x is not null)")
    taken = written(taken, "negatives-rows")
    lengths = taken.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if lengths is None:
        return spark.createDataFrame([], out)
    dims, n = lengths
    taken = taken.where(F.size("vec") == dims)
    drawn = taken.where(F.pmod(F.xxhash64("id", "vec"), F.lit(-(-n // SAMPLE))) == 0).limit(2 * SAMPLE).select("vec").toArrow()
    sample = drawn.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dims) if len(drawn) else np.zeros((1, dims))
    low_end, high_end = np.quantile(sample, [0.01, 0.99], axis=0)
    # cells of one size for all dimensions, so that the widest ones lead the curve
    side = max(1.0, float((high_end - low_end).max()) / 4)
    cuts = (low_end + high_end) / 2 + side * np.array([[-1.0], [0.0], [1.0]])
    parts = max(1, min(shuffle_partitions(spark), -(-n // BLOCK)))
    ordered = taken.mapInArrow(_keys(cuts), "id long, label long, vec array<int>, anchor boolean, curve binary") \
        .repartitionByRange(parts, "curve", "id").sortWithinPartitions("curve", "id")
    blocks = written(ordered.mapInArrow(_stored(BLOCK), BLOCKS), "negatives-blocks")
    zones = blocks.select("block", "lo", "hi", "least", "kinds")
    n_pages = -(-zones.count() // PAGE)
    pages = zones.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(n_pages)).cast("int")) \
        .groupBy("page").applyInArrow(_paged, PAGES)
    pages = written(pages, "negatives-zones")
    asking = written(blocks.mapInArrow(_anchors_of, "key long, id long, label long, vec binary"), "negatives-anchors")
    n_anchors = asking.count()
    if not n_anchors:
        return spark.createDataFrame([], out)
    chunks = written(asking.repartitionByRange(min(parts, -(-n_anchors // CHUNK)), "key").sortWithinPartitions("key")
                     .mapInArrow(_chunked, CHUNKS), "negatives-chunks")
    whole = written(chunks.mapInArrow(_everything, "chunk long, anchor long, lower long, upper long"), "negatives-whole")
    positives = _search(chunks, whole, blocks, pages, n_pages, True, n_pos, "positives")
    # score s of a negative: low[0] * p <= low[1] * s and s <= p, so none if p < 0
    lower = F.expr(f"({low[0]} * score + {low[1] - 1}) div {low[1]}")
    windows = positives.where("score >= 0").select("anchor", "score").distinct().select("anchor", lower.alias("lower"), F.col("score").alias("upper")) \
        .where("lower <= upper").join(whole.select("chunk", "anchor"), "anchor")
    windows = written(windows.select("chunk", "anchor", "lower", "upper"), "negatives-windows")
    negatives = _search(chunks, windows, blocks, pages, n_pages, False, n_neg, "negatives")
    asked = positives.select("anchor", "anchor_id", F.col("id").alias("positive"), F.col("score").alias("upper"))
    found = negatives.select("anchor", "upper", "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score"))
    return asked.join(found, ["anchor", "upper"]).select(
        public_id("anchor_id").alias("anchor_id"), public_id("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        public_id("negative").alias("negative_id"), F.col("upper").alias("positive_score"), "negative_score")
