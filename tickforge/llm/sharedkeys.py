"""Which 64-bit keys occur in several documents?  An exact filter (without
false negatives) in front of operators that would else shuffle every key.

Chunks of documents send each distinct key once, as four bytes in the row of
its bucket, so a key that a third of all documents hold arrives once a chunk.
Each bucket answers each chunk with those of its keys that another document
has.  A key has ``bits`` + 32 bits here: rare false positives only cost work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickforge.llm.arrowtext import U64

SENT = "bucket int, chunk long, low binary, several binary"
SHARED = "chunk long, bucket int, low binary"


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)


def low_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(32 - bits)).astype(np.uint32)


def cuts(ordered: np.ndarray) -> np.ndarray:
    """Where groups of equal values begin, and the length."""
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else []
    return np.append(heads, len(ordered)).astype(np.int64)


def send(chunk: int, keys: np.ndarray, owners: np.ndarray, bits: int) -> pa.Table:
    """A chunk's keys by bucket; owners: the id of each key's document."""
    order = np.lexsort([owners, keys])
    k, o = keys[order], owners[order]
    heads = cuts(k)
    several = o[heads[:-1]] != o[heads[1:] - 1]
    unique = k[heads[:-1]]
    bucket, low = bucket_of(unique, bits), low_of(unique, bits)
    cut = cuts(bucket)
    return pa.table({
        "bucket": pa.array(bucket[cut[:-1]], pa.int32()),
        "chunk": pa.array(np.full(len(cut) - 1, chunk), pa.int64()),
        "low": pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
        "several": pa.array([np.packbits(several[a:b]).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())})


def _answer(key, rows):
    lows = [np.frombuffer(x, np.uint32) for x in rows.column("low").to_pylist()]
    marks = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(low)).astype(bool)
             for x, low in zip(rows.column("several").to_pylist(), lows)]
    n = np.concatenate([[0], np.cumsum([len(x) for x in lows])])
    # one sort of all chunks' keys, each with its place below it
    ordered = np.sort(np.concatenate(lows).astype(U64) << U64(32) | np.arange(n[-1], dtype=U64))
    place, value = (ordered & U64(0xFFFFFFFF)).astype(np.int64), ordered >> U64(32)
    same = value[1:] == value[:-1]
    found = np.concatenate(marks)
    found[place[1:][same]] = True
    found[place[:-1][same]] = True
    own = [low[found[a:b]] for low, a, b in zip(lows, n, n[1:])]
    some = [i for i, x in enumerate(own) if len(x)]
    return pa.table({"chunk": rows.column("chunk").take(pa.array(some, pa.int64())),
                     "bucket": pa.array([key[0].as_py()] * len(some), pa.int32()),
                     "low": pa.array([own[i].tobytes() for i in some], pa.binary())})


def shared(sent: DataFrame) -> DataFrame:
    """(chunk, bucket, low) for each chunk with keys that several documents have."""
    return sent.groupBy("bucket").applyInArrow(_answer, SHARED)


def is_shared(keys: np.ndarray, marks: pa.Table, bits: int) -> np.ndarray:
    """Which of a chunk's keys are among its ``shared`` rows."""
    known = [np.frombuffer(x, np.uint32).astype(U64) | (U64(b) << U64(32))
             for b, x in zip(marks.column("bucket").to_pylist(), marks.column("low").to_pylist())]
    if not known or not len(keys):
        return np.zeros(len(keys), bool)
    mine = bucket_of(keys, bits).astype(U64) << U64(32) | low_of(keys, bits).astype(U64)
    return np.isin(mine, np.concatenate(known))
