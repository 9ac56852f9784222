"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is short, a document long, so whole-document MinHash would not
meet.  Items are partitioned by their number of shingles into classes whose
sizes grow by ``GROWTH``.  For each class a document is seen through sliding
windows as long as the class's largest item: a window over the place where an
item stands has about the item's size, and its MinHash coordinates agree with
the item's with the probability of their Jaccard similarity.  (class,
coordinate, value) triples of windows and items are joined; pairs that meet in
any of ``COORDINATES`` are verified: the item's distinct five-word shingles
that the document has, anywhere, against ``threshold``.  At containment 0.8 a
pair is missed with probability below 1e-5.

Only shingles of items can make a coordinate agree.  Bitmaps of the items'
shingles and triples, of fixed size whatever the benchmark's, are broadcast;
documents without such a shingle are passed over, and the others keep just
those shingles, which is all that the exact check needs, and the triples in
the bitmap.  Bitmaps have false hits only.  Everything else is joined by shuffles, so neither the documents nor the
benchmark need fit anywhere.

A null or empty item or text has no shingles and matches nothing.  An item of
fewer than five words has one shingle, its whole word sequence, and matches
only a text of the same words.  Repeated items are reported under each of
their ids; rows with the same document id are one document if their texts are
equal, and each is searched if not.  Null document ids are reported as null;
an item without an id matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.arrowtext import U64, mix, pieces, text_shingles
from tickforge.llm.common import documents, public_id, ship, written

THRESHOLD = 0.8
COORDINATES = 20
GROWTH = 1.25
#: Size of each broadcast bitmap: 2**BITMAP_BITS bits.
BITMAP_BITS = 23
#: Tokens that ``spans`` looks at in one go, about 20 bytes each.
SPAN_CELLS = 1 << 22


def size_classes(top: int, growth: float = GROWTH) -> list[int]:
    """Largest item size of each class, up to one that holds ``top``."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * growth)))
    return out


def coordinate(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash of each shingle; never 0."""
    return mix(h ^ U64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) | U64(1)


def triple(values: np.ndarray, size: int, k: int) -> np.ndarray:
    return mix(values + U64(size * 1000003 + k)).view(np.int64)


def _items(classes: list[int], coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                h, offs, _ = text_shingles(piece.column("text"))
                own = [np.unique(h[a:b]) for a, b in zip(offs[:-1], offs[1:])]
                keys, sizes = [], []
                for s in own:
                    size = classes[int(np.searchsorted(classes, len(s)))] if len(s) else 0
                    sizes.append(size)
                    keys.append(np.concatenate([triple(coordinate(s, k).min(keepdims=True), size, k)
                                                for k in range(coordinates)]) if len(s) else [])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64())),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                    names=["id", "shingles", "keys", "size"])
    return run


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (mix(h) >> U64(64 - bits)).astype(np.int64)


def _in(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    slot = _slots(h, bits)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def spans(values: np.ndarray, at: np.ndarray, top: int, cells: int = SPAN_CELLS) -> np.ndarray:
    """For each place in ``at``: how many tokens the longest window has in
    which it is the smallest, looking ``top`` tokens to either side; as many
    places at once as have ``cells`` tokens to look at."""
    per = max(1, cells // top)
    if len(at) > per:
        return np.concatenate([spans(values, at[a:a + per], top, cells) for a in range(0, len(at), per)])
    padded = np.concatenate([np.zeros(top, U64), values, np.zeros(top, U64)])
    step = np.arange(1, top + 1)
    here = values[at][:, None]

    def free(side):
        smaller = padded[at[:, None] + top + side * step] < here
        return np.where(smaller.any(1), smaller.argmax(1), top)

    return free(1) + free(-1) + 1


def document_triples(h: np.ndarray, offs: np.ndarray, hits: np.ndarray, classes: list[int], coordinates: int,
                     wanted) -> tuple[np.ndarray, np.ndarray]:
    """(document, triple) of all documents' windows whose smallest token is at
    a hit, as far as ``wanted(triples)``.  A window is the whole document where
    that is shorter."""
    n = np.diff(offs)
    # a 0 between documents ends every window
    flat = np.zeros(len(h) + len(n), U64)
    flat[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
    doc = np.searchsorted(offs, hits, "right") - 1
    at, size_of = hits + doc, n[doc]
    top = min(classes[-1], int(n.max()))
    docs, keys = [], []
    for k in range(coordinates):
        v = coordinate(flat, k)
        v[offs[1:] + np.arange(len(n))] = 0
        span = spans(v, at, top)
        for size in classes:
            some = span >= np.minimum(size, size_of)
            own = triple(v[at[some]], size, k)
            keep = wanted(own)
            docs.append(doc[some][keep])
            keys.append(own[keep])
    docs, keys = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort([keys, docs])
    docs, keys = docs[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
    return docs[new], keys[new]


def _hits(sent, bits: int, classes: list[int], coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle_map, key_map = sent.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                h, offs, _ = text_shingles(piece.column("text"))
                hit = np.flatnonzero(_in(shingle_map, h, bits))
                doc = np.searchsorted(offs, hit, "right") - 1
                rows, first = np.unique(doc, return_index=True)
                if not len(rows):
                    continue
                n = np.diff(offs)[rows]
                local = np.concatenate([[0], np.cumsum(n)])
                own = h[np.arange(local[-1]) + np.repeat(offs[rows] - local[:-1], n)]
                mine = hit - np.repeat(offs[rows] - local[:-1], np.diff(np.append(first, len(hit))))
                of, keys = document_triples(own, local, mine, classes, coordinates,
                                            lambda x: _in(key_map, x.view(U64), bits))
                ends = np.searchsorted(of, np.arange(len(rows) + 1)).astype(np.int32)
                sets = [np.unique(x).view(np.int64) for x in np.split(h[hit], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(x).take(pa.array(rows, pa.int64())) for x in ("id", "version")]
                    + [pa.array(sets, pa.list_(pa.int64())),
                       pa.ListArray.from_arrays(pa.array(ends), pa.array(keys, pa.int64()))],
                    names=["id", "version", "hits", "keys"])
    return run


def _bitmap(items: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of a list column, put together by Spark: its bytes that are not
    zero reach the driver, 2**(bits - 3) at most."""
    def slots(batches):
        for batch in batches:
            own = batch.column(column).flatten().to_numpy(zero_copy_only=False).view(U64)
            s = _slots(own, bits)
            yield pa.RecordBatch.from_arrays([pa.array(s >> 3), pa.array((1 << (s & 7)).astype(np.int64))],
                                             names=["byte", "bit"])

    got = items.select(column).mapInArrow(slots, "byte long, bit long") \
        .groupBy("byte").agg(F.bit_or("bit").alias("v")).toArrow()
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[got.column("byte").to_numpy()] = got.column("v").to_numpy().astype(np.uint8)
    return out


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
            coordinates: int = COORDINATES, bits: int = BITMAP_BITS) -> DataFrame:
    """(id, version, item, n_shared, n_item) of every text that has
    ``threshold`` of an item's shingles; version is the text's xxhash64."""
    spark = docs.sparkSession
    ship(spark)
    own = items.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    key_type = own.schema["id"].dataType.simpleString()
    words = own.agg(F.max(F.size(F.split(F.trim("text"), "[ \\t\\n\\x0B\\f\\r]+")))).first()[0] or 0
    classes = size_classes(max(1, words - 4))
    tests = written(own.mapInArrow(_items(classes, coordinates),
                                   f"id {key_type}, shingles array<long>, keys array<long>, size long"),
                    "test-items")
    # the classes that have items, far fewer than sizes
    classes = sorted(r[0] for r in tests.select("size").where("size > 0").distinct().collect()) or [1]
    sent = spark.sparkContext.broadcast((_bitmap(tests, "shingles", bits), _bitmap(tests, "keys", bits)))
    found = written(documents(docs, id_col, text_col).withColumn("version", F.xxhash64("text")).mapInArrow(
        _hits(sent, bits, classes, coordinates), "id long, version long, hits array<long>, keys array<long>"), "test-hits")
    left = found.select("id", "version", F.explode("keys").alias("key")).distinct()
    right = tests.select(F.col("id").alias("item"), F.explode("keys").alias("key"))
    # each item once for each text, however many coordinates agree
    pairs = left.join(right, "key").select("id", "version", "item").distinct()
    joined = pairs.join(found.select("id", "version", "hits").dropDuplicates(["id", "version"]), ["id", "version"]) \
        .join(tests.select(F.col("id").alias("item"), "shingles").dropDuplicates(["item", "shingles"]),
              "item")
    sized = joined.select("id", "version", "item", F.size(F.array_intersect("hits", "shingles")).cast("long").alias("n_shared"),
                          F.size("shingles").cast("long").alias("n_item"))
    return sized.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - 1e-9)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
                 coordinates: int = COORDINATES, bits: int = BITMAP_BITS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every document
    that has ``threshold`` of an item's shingles."""
    found = matches(docs, items, id_col, text_col, item_col, item_text_col, threshold, coordinates, bits)
    kept = found.groupBy("id", "item").agg(F.max(F.struct(
            (F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("m"))
    return kept.select(public_id().alias(id_col), F.col("item").alias(item_col), "m.n_shared", "m.n_item", "m.containment")
