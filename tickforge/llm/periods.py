"""Periodic runs of words, found by multi-scale minimizers.

A run is a maximal stretch of consecutive words with smallest period q (words
q apart are identical) that is at least ``min_exponent`` periods and
``min_length`` words long.  Words are ``[^\\x20\\x09-\\x0D]+``, as written
(no lower-casing); words are compared by 64-bit hashes.

Periods up to ``DIRECT`` are found by direct lag scans: the words of a lag's
unbroken stretches of equality.  Longer ones are found scale by scale.  Scale
K = 16, 32, ... covers the periods q with K/2 < q <= K.  Its tokens are the
K-grams, its windows are of W = K/2 tokens, and the minimum of each window is
selected.  Inside a run equal K-grams are exactly multiples of q apart (two at
a smaller distance d would give the run the period gcd(d, q), as K >= q).  So a
window has no ties there, and the window q words later, which lies in the run
as well because K + q + W - 1 <= 4q - 4, selects the same K-gram q words later.
The next selected place of that K-gram is that one, so every run of four
periods has a pair of equal neighbouring minimizers at its distance.  These
pairs are the seeds: each is extended word by word in both directions, and what
reaches the required length is a run.  A stretch that is also one of a smaller
period (a divisor) is reported with the smallest.  The result is exact.

Each text is worked on by itself, nothing is shuffled.  Memory is that of a
piece of texts (about one megabyte, or one text if it is longer), some 100
bytes for each word.

``collapse`` returns one row for each input row.  A null or empty text, or one
of spaces, has no words and no runs, and collapses to the empty text.  Repeated
rows and null ids are rows like others; columns other than the id and the text
are not read, so their names cannot clash.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.arrowtext import U64, mix, pieces, powers, sliding_max, sliding_min, utf8, word_hashes
from tickforge.llm.common import ship

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Periods up to this are scanned directly; half the smallest scale.
DIRECT = 8

RUN = "array<struct<start:long,length:long,period:long>>"
_NOTHING = U64(0xFFFFFFFFFFFFFFFF)


def lag_stretches(words: np.ndarray, ends: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal [start, end) of at least ``least`` words in which words q apart
    are equal; ``ends``: where the texts end."""
    if len(words) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(words) - q + 2, np.int8)
    same[1:-1] = words[q:] == words[:-q]
    across = (ends[:, None] - np.arange(q, 0, -1)).ravel()
    same[across[(across >= 0) & (across < len(words) - q)] + 1] = 0
    edge = np.flatnonzero(np.diff(same))
    start, end = edge[::2], edge[1::2] + q
    long = end - start >= least
    return start[long], end[long]


def seeds(words: np.ndarray, ends: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of neighbouring equal minimizers of the scale whose
    distance is one of its periods."""
    n, w = len(words), scale // 2
    if n < scale + w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = np.zeros(n + 1, U64)
    np.cumsum(words * powers("base", n), dtype=U64, out=sums[1:])
    grams = mix((sums[scale:] - sums[:-scale]) * powers("inverse", n)[:n - scale + 1])
    # K-grams across the end of a text are never selected
    across = (ends[:-1, None] - np.arange(scale - 1, 0, -1)).ravel()
    grams[across[(across >= 0) & (across < len(grams))]] = _NOTHING
    least = np.zeros(len(grams) + w - 1, U64)  # of the windows that end at each place
    least[w - 1:len(grams)] = sliding_min(grams, w)
    at = np.flatnonzero((sliding_max(least, w) == grams) & (grams != _NOTHING))
    order = np.argsort(grams[at], kind="stable")
    at, value = at[order], grams[at][order]
    gap = at[1:] - at[:-1]
    # (neighbours of two texts that are so near have a text's end between them)
    pair = (value[1:] == value[:-1]) & (gap > w) & (gap <= scale)
    place, gap = at[:-1][pair], gap[pair]
    inside = np.searchsorted(ends, place, "right") == np.searchsorted(ends, place + gap, "right")
    return place[inside], gap[inside]


def extend(text: np.ndarray, place: int, q: int) -> tuple[int, int]:
    """The maximal [start, end) around ``place`` with period q."""
    last, right, left = len(text) - q, place, place
    step = 64
    while right < last:
        stop = min(last, right + step)
        bad = text[right:stop] != text[right + q:stop + q]
        if bad.any():
            right += int(bad.argmax())
            break
        right, step = stop, 2 * step
    step = 64
    while left > 0:
        start = max(0, left - step)
        bad = text[start:left] != text[start + q:left + q]
        if bad.any():
            left -= int(bad[::-1].argmax())
            break
        left, step = start, 2 * step
    return left, right + q


def runs(words: np.ndarray, offs: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period;
    text k has the words ``offs[k]:offs[k + 1]``."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q in range(1, DIRECT + 1):
        start, end = lag_stretches(words, offs[1:], q, max(min_length, min_exponent * q))
        found.append((start, end, np.full(len(start), q)))
    lengths = np.diff(offs)
    scale = 2 * DIRECT
    part, part_offs, origin = words, offs, offs[:-1]
    while len(lengths) and lengths.max() >= min_exponent * (scale // 2 + 1):
        enough = lengths >= min_exponent * (scale // 2 + 1)
        if not enough.all():
            part = part[np.repeat(enough, lengths)]
            lengths, origin = lengths[enough], origin[enough]
            part_offs = np.concatenate([[0], np.cumsum(lengths)])
        place, gap = seeds(part, part_offs[1:], scale)
        text = np.searchsorted(part_offs, place, "right") - 1
        order = np.lexsort([place, gap, text])
        reached, own = -1, []
        before = (-1, -1)
        for k in order:
            t, q = int(text[k]), int(gap[k])
            p = int(place[k] - part_offs[t])
            if (t, q) != before:
                before, reached = (t, q), -1
            if p + q < reached:
                continue  # in the stretch that the seed before has found
            start, end = extend(part[part_offs[t]:part_offs[t + 1]], p, q)
            reached = end
            if end - start >= max(min_length, min_exponent * q):
                own.append((origin[t] + start, origin[t] + end, q))
        if own:
            found.append(tuple(np.array(x, np.int64) for x in zip(*own)))
        scale *= 2
    start, end, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort([q, end, start])
    start, end, q = start[order], end[order], q[order]
    first = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else np.zeros(0, bool)
    start, end, q = start[first], end[first], q[first]
    text = np.searchsorted(offs, start, "right") - 1
    order = np.lexsort([q, start, text])
    return text[order], (start - offs[text])[order], (end - start)[order], q[order]


def _collapsed(text: bytes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    words = text.split()
    if not len(start):
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)])


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): runs by start and period (word
    numbers from 0), and the text's words, joined by one space, without those
    that any run contains after its first period."""
    if min_exponent < 4:
        raise ValueError("runs of fewer than four periods can be without a seed")
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text")
                words, of = word_hashes(*utf8(texts), fold=False)
                n = np.bincount(of, minlength=len(texts))
                text, *found = runs(words, np.concatenate([[0], np.cumsum(n)]), min_length, min_exponent)
                at = np.searchsorted(text, np.arange(len(texts) + 1))
                kept = [_collapsed(x, *(v[a:b] for v in found)) for x, a, b in zip(texts.to_pylist(), at, at[1:])]
                yield pa.RecordBatch.from_arrays([
                    piece.column("id"), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(v, pa.int64()) for v in found], fields=list(fields))),
                    pa.array(kept, pa.binary())], names=["id", "n_words", "runs", "collapsed"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n_words long, runs {RUN}, collapsed binary").select(
        F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
