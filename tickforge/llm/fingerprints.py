"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the k smallest distinct 64-bit hashes of a text's five-word
shingles.  Sketches of parts merge into the sketch of the whole.  They
estimate resemblance (share of the union), containment and the number of
distinct shingles; with fewer than k shingles the estimates are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.arrowtext import U64, pieces, text_shingles
from tickforge.llm.common import documents, public_id, shuffle_partitions

K = 128


def sketches(texts: pa.Array, k: int = K, width: int = 5) -> list[np.ndarray]:
    """The sketch of each text: sorted distinct hashes, k at most.  A null,
    empty or blank text has an empty sketch."""
    h, offs, _ = text_shingles(texts, width)
    return [np.unique(h[a:b])[:k] for a, b in zip(offs[:-1], offs[1:])]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of two shingle sets."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; 1 for two empty sketches."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, True), both, True)) / len(both)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) / ((float(a[k - 1]) + 1) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def encode(a: np.ndarray) -> str:
    """16 lowercase hex digits for each hash, ascending."""
    return a.astype(">u8").tobytes().hex()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), ">u8").astype(U64)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_distinct) of every row; no shuffle."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                own = sketches(piece.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(map(encode, own), pa.string()),
                     pa.array([distinct(x, k) for x in own], pa.float64())],
                    names=["id", "fingerprint", "n_distinct"])

    out = documents(docs, id_col, text_col).mapInArrow(run, "id long, fingerprint string, n_distinct double")
    return out.select(public_id().alias(id_col), "fingerprint", "n_distinct")


def merged(prints: DataFrame, group_cols: list[str], fingerprint_col: str = "fingerprint", k: int = K) -> DataFrame:
    """The sketch of each group's union.  Parts are cut to the k smallest
    hashes on both sides of the shuffle, so a group's size does not matter."""
    h = F.explode(F.expr(f"transform(sequence(1, length({fingerprint_col}) div 16),"
                         f" i -> substr({fingerprint_col}, (i - 1) * 16 + 1, 16))")).alias("h")
    rows = prints.where(f"length({fingerprint_col}) > 0").select(*group_cols, h).distinct()
    from pyspark.sql import Window
    w = Window.partitionBy(*group_cols).orderBy("h")
    top = rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
    return top.groupBy(*group_cols).agg(F.concat_ws("", F.sort_array(F.collect_list("h"))).alias(fingerprint_col))


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 4) code points replaced by as many
    (or all) of the first of the following text."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _compare(k: int):
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def result(ids, texts):
        own = sketches(pa.array(texts, pa.string()), k)
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        theirs = sketches(pa.array(changed, pa.string()), k)
        n = len(changed)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[:n], pa.int64()), pa.array([len(x) for x in texts[:n]], pa.int64()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
             pa.array([encode(x) for x in own[:n]], pa.string()), pa.array([encode(x) for x in theirs], pa.string()),
             pa.array([resemblance(a, b, k) for a, b in zip(own, theirs)], pa.float64()),
             pa.array([resemblance(a, b, k) for a, b in zip(own, own[1:])], pa.float64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row so far, which waits for its next document
        for batch in batches:
            for piece in pieces(batch, "text"):
                ids, texts = [], []
                rows = zip(*(piece.column(c).to_pylist() for c in ("part", "ahead", "id", "text")))
                for part, ahead, key, text in rows:
                    if before and before[0] != part:
                        before = None
                        if len(texts) > 1:
                            yield result(ids, texts)
                        ids, texts = [], []
                    if before and not ids:
                        ids, texts = [before[1]], [before[2]]
                    if before is None and ahead:
                        continue  # a part has one row ahead; repeated rows of it are not needed
                    ids.append(key)
                    texts.append(text)
                    before = None if ahead else (part, key, text)
                    if ahead:
                        yield result(ids, texts)
                        ids, texts = [], []
                if len(texts) > 1:
                    yield result(ids, texts)

    return run


def _listed(values: list, kind: str):
    """An array constant, one literal in the plan whatever its length."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of each text and of its edited text (see ``edited``; the
    following text is that of the next id, after the last id the first).

    Ids are cut into ranges at ids of the data, so the first row of a range
    is known without looking: that row is also sent to the range before, and
    each range then has every pair of neighbours.  The texts are shuffled
    once; a range is sorted and streamed, never held.

    Rows are ordered by (id, text), null ids last; repeated rows follow one
    another.  A single row is its own next document.  A null text is empty.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = documents(docs, id_col, text_col)
    parts = 8 * shuffle_partitions(docs.sparkSession)
    shares = _listed([i / parts for i in range(1, parts)], "double")
    marks = rows.agg(F.min("id").alias("first"), F.percentile_approx("id", shares, 20 * parts).alias("cuts")).first()
    names = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string," \
            " near_edited double, near_next double"
    first = 0 if marks["first"] is None else marks["first"]
    cuts = sorted({first, *(marks["cuts"] or [])})
    splits = _listed(cuts, "bigint")

    def halves(low, step):  # the last cut that is not above the id
        at = low + step
        return F.when(F.get(splits, at) <= F.col("id"), at).otherwise(low)

    steps = [1 << k for k in reversed(range((len(cuts) - 1).bit_length()))]
    place = F.aggregate(_listed(steps, "int"), F.lit(0), halves) if steps else F.lit(0)
    rows = rows.withColumn("own", place)
    first_of_part = F.element_at(splits, F.col("own") + 1) == F.col("id")
    before = F.pmod(F.col("own") - 1, F.lit(len(cuts)))
    both = F.when(first_of_part, F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("ahead")),
                                         F.struct(before.alias("part"), F.lit(True).alias("ahead")))) \
        .otherwise(F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("ahead"))))
    sent = rows.select("id", "text", F.inline(both)).repartition("part") \
        .sortWithinPartitions("part", "ahead", "id", "text").select("part", "ahead", "id", "text")
    out = sent.mapInArrow(_compare(k), names)
    return out.select(public_id().alias(id_col), *[c for c in out.columns if c != "id"])
