"""Vectorised text kernels shared by the operators of this subpackage.

All functions work on one piece of an Arrow batch inside a task: the UTF-8
bytes of some whole texts laid end to end, with their offsets.  Memory is
bounded by the piece size (about one megabyte of text, or one text if it is
longer).

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A text with fewer
words than the shingle width has one shingle, its whole word sequence; a text
without words has none.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers = {"base": np.ones(1, U64), "inverse": np.ones(1, U64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A random 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * _BASE)
#: A random odd multiplier for each place in a shingle.
PLACE_VALUES = mix(np.arange(1001, 1257, dtype=U64) * _BASE) | U64(1)


def powers(kind: str, n: int) -> np.ndarray:
    """The first n powers of the hash base or of its inverse, modulo 2**64."""
    if len(_powers[kind]) < n:
        step = np.full(max(n, 1 << 16), _BASE if kind == "base" else _INVERSE, U64)
        step[0] = 1
        _powers[kind] = np.cumprod(step, dtype=U64)
    return _powers[kind][:n]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the len(texts) + 1 offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, offs, data = texts.buffers()
    if len(texts) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offs = np.frombuffer(offs, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def word_hashes(data: np.ndarray, offs: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Each word's hash and the index of its text, in order; ``fold``: A-Z count as lower case."""
    n = len(data)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offs[:-1]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    starts = np.flatnonzero(begins)
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | first[1:n]
    ends = np.flatnonzero(finishes) + 1
    sums = np.empty(n + 1, U64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[LOWER[data] if fold else data] * powers("base", n), dtype=U64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers("inverse", n)[starts]
    h = mix(h + (ends - starts).astype(U64) * _BASE)
    return h, np.searchsorted(offs, starts, "right") - 1


def shingles(words: np.ndarray, docs: np.ndarray, n_docs: int, width: int = 5
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in text order, the offsets of each text's shingles, and
    each text's number of words."""
    counts = np.bincount(docs, minlength=n_docs)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    per = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offs = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(offs[-1]) - np.repeat(offs[:-1] - firsts[:-1], per)
    wide = np.repeat(np.minimum(counts, width), per)
    h = wide.astype(U64) * _BASE
    for j in range(width):
        there = wide > j
        if there.all():
            h += words[at + j] * PLACE_VALUES[j]
        else:
            h[there] += words[at[there] + j] * PLACE_VALUES[j]
    return mix(h), offs, counts


def text_shingles(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``shingles`` of an Arrow array of texts."""
    data, offs = utf8(texts)
    words, docs = word_hashes(data, offs)
    return shingles(words, docs, len(texts), width)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values; by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    """Maximum of every run of ``width`` values; by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.maximum(out[:-step], out[step:])
        have += step
    return out
