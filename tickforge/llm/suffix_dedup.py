"""Exact substring de-duplication with a suffix array built block by block.

A byte is removed if a string of ``LENGTH`` bytes covers it that also starts in
a document with a smaller id.  So the question for each suffix is: which is the
smallest id among the suffixes with the same first ``LENGTH`` bytes?  Suffixes
are sorted one bucket at a time; equal ones then lie side by side.

Chunks.  Texts are dealt into chunks of a couple of megabytes by a hash of the id,
by one shuffle that all three passes over the texts read again.

Buckets.  A suffix belongs to the bucket of its minimizer: the smallest-hash
string of ``ANCHOR`` bytes within its first ``LENGTH`` bytes.  Equal suffixes
have the same one, and a run of neighbouring suffixes mostly shares one, so a
run is sent as one short string (the run's suffixes, cut at LENGTH bytes).

1. Each chunk sends each distinct minimizer once (four bytes).  Minimizers that
   only one document has are done: nothing can match there.
2. For the others each chunk sends each distinct run once, with the smallest id
   that has it.  So a text that a third of all documents hold is one string a
   chunk, and no bucket holds copies.
3. Each bucket joins equal runs and sorts the suffixes of the rest, a bounded
   block of minimizers at a time (``block_order``), and answers for each run
   which suffixes stand in a smaller document.  Chunks mark and cut their texts.

``block_order`` is difference-cover sorting: the suffixes at the positions of a
difference cover modulo ``PERIOD`` are ranked first; all suffixes are sorted by
their first PERIOD bytes, and ties are resolved by comparing ranks: for any two
positions some shift under PERIOD takes both into the cover.  A tie of any
length thus costs one look.  A block's arrays take about 120 bytes a byte.  One
minimizer with more than a block of distinct runs (a common line of 24 to 49
bytes, each time with other text around it) is divided by what follows
(``_hot_minimizer``), so no block is larger.  What a task holds besides are its
bucket's distinct runs: some 200 bytes each, 1 KB where the minimizer is hot.

A null text is empty.  Rows with one id never remove each other's bytes.  Null
ids come last and count as one id.  Repeated rows stay.  Texts shorter than
LENGTH bytes are left alone.  Other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.arrowtext import U64, mix, sliding_min, utf8
from tickforge.llm.common import documents, public_id, shuffle_partitions
from tickforge.llm.sharedkeys import SENT, bucket_of, cuts, is_shared, send, shared

LENGTH = 50
ANCHOR = 24
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
#: {0, 1, 3, 9} is a perfect difference set modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)


def _shifts() -> np.ndarray:
    """For residues (a, b): the least d with a + d and b + d in the cover."""
    inside = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    return np.array([[next(d for d in range(PERIOD) if inside[a + d] and inside[b + d])
                      for b in range(PERIOD)] for a in range(PERIOD)])


SHIFT = _shifts()


def words_at(data: np.ndarray, at: np.ndarray, count: int) -> list[np.ndarray]:
    """``count`` big-endian 64-bit words from each position; data must be
    padded with 8 * count bytes."""
    every = np.ndarray((len(data) - 7,), ">u8", np.ascontiguousarray(data), 0, (1,))
    return [every[at + 8 * k].astype(U64) for k in range(count)]


def equal_groups(keys: list[np.ndarray]) -> np.ndarray:
    """A group number for each row of the key columns; rows of one group are
    equal.  (Sorted by a hash, then compared in full.)"""
    h = np.zeros(len(keys[0]), U64)
    for k in keys:
        h = mix(h + k)
    order = np.argsort(h, kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def minimizers(data: np.ndarray, anchor: int, window: int, block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the ``anchor`` bytes at each position, and for each run of
    ``window`` positions the one with the smallest hash (its first 32 bits;
    the leftmost of equal ones).  Block by block, to stay in the cache."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(anchor + 8, np.uint8)])
    hashes, least = np.empty(n, U64), np.empty(max(0, n - window + 1), np.int64)
    for a in range(0, len(least), block):
        b = min(a + block + window - 1, n)
        h = np.zeros(b - a, U64)
        for k in range(0, anchor, 8):
            # the last word may overlap the one before
            h = mix(h + np.ndarray((b - a,), "<u8", padded, a + min(k, anchor - 8), (1,)))
        hashes[a:b] = h
        low = sliding_min((h & ~U64(0xFFFFFFFF)) | np.arange(a, b, dtype=U64), window) & U64(0xFFFFFFFF)
        least[a:a + len(low)] = low
    return hashes, least


def dense_rank(keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each row of the key columns; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def merge_sorted(order: np.ndarray, groups: np.ndarray, less) -> np.ndarray:
    """Sort each group (offsets in ``groups``) of ``order`` by the vectorised
    comparison ``less(a, b)``: bottom-up merges of all groups at once."""
    size = np.diff(groups)
    group = np.repeat(np.arange(len(size)), size)
    start, end = groups[group], groups[group + 1]
    inside = np.arange(len(order)) - start
    width = 1
    while len(size) and width < size.max():
        run = inside // width
        low = start + (run // 2) * 2 * width
        other = np.minimum(np.where(run % 2, low, low + width), end)
        top = np.minimum(other + width, end)
        right = run % 2 == 1
        lo, hi = other.copy(), top.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            mine, theirs = order[open_], order[mid]
            # elements of the left run come first among equals
            before = np.where(right[open_], ~less(mine, theirs), less(theirs, mine))
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        place = low + (inside % width) + (lo - other)
        out = np.empty_like(order)
        out[place] = order
        order = out
        width *= 2
    return order


def masked_words(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, count: int) -> list[np.ndarray]:
    """``words_at``, with zeros from the ``sizes``-th byte on."""
    out = []
    for k, w in enumerate(words_at(data, at, count)):
        over = np.clip(8 * (k + 1) - sizes, 0, 8)
        out.append(w & np.where(over >= 8, U64(0), ~U64(0) << (8 * np.minimum(over, 7)).astype(U64)))
    return out


def block_order(data: np.ndarray, ends: np.ndarray, suffixes: np.ndarray, length: int, longest: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes (positions in data) of a block of strings that stand
    end to end: the sorted positions, and for each the number of its class of
    equal first ``length`` bytes.

    ``ends`` has each position's end of string; strings have ``longest`` bytes
    at most and order as if followed by zeros; suffixes have ``length`` bytes.
    """
    n = len(data)
    data = np.concatenate([data, np.zeros(longest + 24, np.uint8)])
    count = -(-length // 8)
    sample = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    rank = np.zeros(n, np.int64)
    rank[sample] = dense_rank(masked_words(data, sample, ends[sample] - sample, -(-longest // 8)))
    first = words_at(data, suffixes, 2)
    first[1] &= ~U64((1 << 8 * (16 - PERIOD)) - 1)
    order = np.lexsort(first[::-1])
    a, b = first[0][order], first[1][order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.append(np.flatnonzero(new), len(order))
    sizes = np.diff(heads)
    tied = np.repeat(sizes > 1, sizes)

    def less(x, y):
        d = SHIFT[x % PERIOD, y % PERIOD]
        return rank[x + d] < rank[y + d]

    out = suffixes[order]
    out[tied] = merge_sorted(out[tied], np.concatenate([[0], np.cumsum(sizes[sizes > 1])]), less)
    # neighbours with the same first bytes: compare all of them
    equal = np.ones(len(out), bool)
    for w in masked_words(data, out, np.full(len(out), length), count):
        equal[1:] &= w[1:] == w[:-1]
    equal[:1] = False
    return out, np.cumsum(~equal)


class Chunk:
    """A chunk's texts in (id, text) order, and the runs of its suffixes."""

    def __init__(self, rows: pa.Table, length: int, anchor: int):
        rows = rows.select(["id", "text"]).sort_by([("id", "ascending"), ("text", "ascending")])
        self.ids = rows.column("id").to_numpy()
        self.data, self.offs = utf8(rows.column("text"))
        self.length, self.longest = length, 2 * length - anchor
        lens = np.diff(self.offs)
        per = np.maximum(lens - length + 1, 0)
        if not per.sum():
            self.starts = self.counts = self.doc = np.zeros(0, np.int64)
            self.prints = np.zeros(0, U64)
            return
        h, low = minimizers(self.data, anchor, length - anchor + 1)
        first = np.repeat(self.offs[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per)
        suffix = np.arange(per.sum()) + first  # all positions with LENGTH bytes in their text
        doc = np.repeat(np.arange(len(lens)), per)
        least = low[suffix]
        new = np.ones(len(suffix), bool)
        new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        self.starts = suffix[heads]
        self.counts = np.diff(np.append(heads, len(suffix)))
        self.doc = doc[heads]
        self.prints = mix(h[least[heads]] ^ U64(0xA5A5A5A5))

    def distinct_runs(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of equal bytes as one: the first of each (in ascending id
        order, so with its smallest id), each chosen run's number, and the
        chosen runs' minimizers."""
        count = -(-self.longest // 8)
        padded = np.concatenate([self.data, np.zeros(8 * count + 8, np.uint8)])
        sizes = self.counts[chosen] + self.length - 1
        keys = [self.prints[chosen], sizes.astype(U64), *masked_words(padded, self.starts[chosen], sizes, count)]
        rank = equal_groups(keys)
        n = int(rank.max()) + 1 if len(rank) else 0
        firsts = np.full(n, len(rank), np.int64)
        np.minimum.at(firsts, rank, np.arange(len(rank)))
        return firsts, rank, keys[0]


def _send_minimizers(bits, length, anchor):
    def run(key, rows):
        chunk = Chunk(rows, length, anchor)
        return send(key[0].as_py(), chunk.prints, chunk.ids[chunk.doc] if len(chunk.doc) else chunk.doc, bits)
    return run


def _in_buckets(chunk: Chunk, chosen: np.ndarray, bits: int):
    """The distinct runs in bucket order: (positions in chosen, run number of
    each chosen run in that order, bucket of each distinct run)."""
    firsts, rank, prints = chunk.distinct_runs(chosen)
    bucket = bucket_of(prints[firsts], bits)
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return firsts[order], number[rank], bucket[order]


def _send_runs(bits, length, anchor):
    def run(key, rows, marks):
        out = {"bucket": [], "chunk": [], "prints": [], "owners": [], "sizes": [], "bytes": []}
        if rows.num_rows and marks.num_rows:
            chunk = Chunk(rows, length, anchor)
            chosen = np.flatnonzero(is_shared(chunk.prints, marks, bits))
            firsts, _, bucket = _in_buckets(chunk, chosen, bits)
            runs = chosen[firsts]
            cut = cuts(bucket)
            sizes = chunk.counts[runs] + length - 1
            for a, b in zip(cut, cut[1:]):
                own = runs[a:b]
                at = np.repeat(chunk.starts[own] - np.concatenate([[0], np.cumsum(sizes[a:b])[:-1]]), sizes[a:b])
                out["bucket"].append(bucket[a])
                out["chunk"].append(key[0].as_py())
                out["prints"].append(chunk.prints[own].tobytes())
                out["owners"].append(chunk.ids[chunk.doc[own]].astype(np.int64).tobytes())
                out["sizes"].append(sizes[a:b].astype(np.uint16).tobytes())
                out["bytes"].append(chunk.data[np.arange(sizes[a:b].sum()) + at].tobytes())
        kinds = {"bucket": pa.int32(), "chunk": pa.int64()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()})
    return run


def _smaller_owners(text, ends, suffixes, owners, length, longest):
    """For each suffix (ascending positions): the smallest owner of the same
    first ``length`` bytes, by ``block_order``."""
    positions, classes = block_order(text, ends, suffixes, length, longest)
    of = np.searchsorted(suffixes, positions)
    heads = cuts(classes)
    least = np.empty(len(suffixes), np.int64)
    least[of] = np.repeat(np.minimum.reduceat(owners[of], heads[:-1]), np.diff(heads))
    return least, of, heads


def _gathered(data, at, size):
    """The bytes of strings (positions, sizes) end to end, and their begins."""
    begins = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    return data[np.arange(size.sum()) + np.repeat(at - begins, size)], begins


def _hot_minimizer(data, starts, counts, owners, length, block):
    """(run, place in it) of the suffixes that also stand in a smaller
    document, for the runs of one minimizer that has more than a block.

    Suffixes are told apart by a hash of all their ``length`` bytes; those
    whose hash no other one has are done.  The others are dealt into parts of a
    block's worth of hashes, and a part is taken in ascending order of owner,
    a block at a time, with one suffix of each class seen so far in front: the
    first owner of a class is its smallest."""
    words = -(-length // 8)
    padded = np.concatenate([data, np.zeros(8 * words + 8, np.uint8)])
    runs = np.repeat(np.arange(len(starts), dtype=np.int32), counts)
    within = (np.arange(len(runs)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint8)
    h = np.empty(len(runs), U64)
    for a in range(0, len(runs), 1 << 16):
        part = slice(a, a + (1 << 16))
        at, own = starts[runs[part]] + within[part], np.zeros(len(runs[part]), U64)
        for w in masked_words(padded, at, np.full(len(at), length), words):
            own = mix(own + w)
        h[part] = own
    ranked = np.sort(h)
    repeated = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    del ranked
    if not len(repeated):
        return runs[:0], within[:0]
    place = np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)
    some = np.flatnonzero(repeated[place] == h)
    per = max(1, block // length)  # suffixes of a block
    part = place[some] // per
    some = some[np.lexsort([owners[runs[some]], part])]
    part = np.sort(part)
    gone = np.zeros(len(some), bool)
    edges = cuts(part)
    for a, b in zip(edges, edges[1:]):
        seen_at, seen_owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for low in range(a, b, per):
            own = some[low:min(low + per, b)]
            at = np.concatenate([seen_at, starts[runs[own]] + within[own]])
            owner = np.concatenate([seen_owner, owners[runs[own]]])
            size = np.full(len(at), length)
            text, begins = _gathered(data, at, size)
            least, of, heads = _smaller_owners(text, np.repeat(begins + length, length), begins, owner, length, length)
            gone[low:low + len(own)] = (least < owner)[len(seen_at):]
            one = of[heads[:-1]]
            seen_at, seen_owner = at[one], least[one]
    return runs[some[gone]], within[some[gone]]


def smallest_owners(prints, owners, sizes, data, length, block=BLOCK_BYTES):
    """For each run, a bit mask of its suffixes that also stand in a document
    with a smaller id than the run's owner."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    counts = sizes - length + 1
    mask = np.zeros(len(prints), U64)
    order = np.argsort(prints, kind="stable")
    cut = cuts(prints[order])
    groups = np.diff(cut)
    order = order[np.repeat(groups > 1, groups)]  # a run that alone has its minimizer has no partner
    if not len(order):
        return mask
    cut = cuts(prints[order])
    totals = np.add.reduceat(sizes[order], cut[:-1])
    hot = totals > block
    for g in np.flatnonzero(hot):
        runs = order[cut[g]:cut[g + 1]]
        run, within = _hot_minimizer(data, starts[runs], counts[runs], owners[runs], length, block)
        np.bitwise_or.at(mask, runs[run], U64(1) << within.astype(U64))
    order = order[np.repeat(~hot, np.diff(cut))]
    if not len(order):
        return mask
    cut = cuts(prints[order])
    edges = cuts(np.cumsum(totals[~hot]) // block)  # minimizers in blocks of bounded size
    for a, b in zip(edges, edges[1:]):
        runs = order[cut[a]:cut[b]]
        size, count = sizes[runs], counts[runs]
        text, begins = _gathered(data, starts[runs], size)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        run_of = np.repeat(np.arange(len(runs)), count)
        least, *_ = _smaller_owners(text, np.repeat(begins + size, size), within + begins[run_of], owners[runs][run_of],
                                    length, int(size.max()))
        gone = least < owners[runs][run_of]
        np.bitwise_or.at(mask, runs[run_of[gone]], U64(1) << within[gone].astype(U64))
    return mask


def _sort_bucket(length):
    def run(key, rows):
        rows = rows.sort_by("chunk")

        def joined(name, kind):
            return [np.frombuffer(x, kind) for x in rows.column(name).to_pylist()]

        prints, owners, sizes = (joined(*x) for x in (("prints", U64), ("owners", np.int64), ("sizes", np.uint16)))
        n = np.concatenate([[0], np.cumsum([len(x) for x in prints])])
        data = np.concatenate(joined("bytes", np.uint8))
        p, o, s = (np.concatenate(x) for x in (prints, owners, sizes))
        s = s.astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(s)[:-1]])
        # equal runs of several chunks as one, owned by the smallest id
        count = -(-int(s.max()) // 8)
        padded = np.concatenate([data, np.zeros(8 * count + 8, np.uint8)])
        rank = equal_groups([p, s.astype(U64), *masked_words(padded, starts, s, count)])
        least = np.full(int(rank.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, rank, o)
        first = np.full(len(least), len(rank), np.int64)
        np.minimum.at(first, rank, np.arange(len(rank)))
        one_size = s[first]
        at = np.repeat(starts[first] - np.concatenate([[0], np.cumsum(one_size)[:-1]]), one_size)
        mask = smallest_owners(p[first], least, one_size, data[np.arange(one_size.sum()) + at], length)[rank]
        # a run that a smaller document has whole is gone whole
        mask[o > least[rank]] = ~U64(0)
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
                         "masks": pa.array([mask[a:b].tobytes() for a, b in zip(n, n[1:])], pa.binary())})
    return run


def _cut(bits, length, anchor):
    def run(key, rows, answers):
        chunk = Chunk(rows, length, anchor)
        covered = np.zeros(len(chunk.data) + 1, np.int32)
        if answers.num_rows:
            marks = answers.filter(pc.is_valid(answers.column("low")))
            chosen = np.flatnonzero(is_shared(chunk.prints, marks, bits))
            firsts, number, _ = _in_buckets(chunk, chosen, bits)
            masks = answers.filter(pc.is_valid(answers.column("masks"))).sort_by("bucket")
            mask = np.concatenate([np.frombuffer(x, U64) for x in masks.column("masks").to_pylist()])[number]
            # in a larger document than the chunk's owner of the run, all of it is gone
            later = chunk.ids[chunk.doc[chosen]] > chunk.ids[chunk.doc[chosen[firsts]]][number]
            mask = np.where(later, ~U64(0), mask)
            count = chunk.counts[chosen]
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            run_of = np.repeat(np.arange(len(chosen)), count)
            gone = (mask[run_of] >> within.astype(U64)) & U64(1) == 1
            at = (chunk.starts[chosen][run_of] + within)[gone]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + length, -1)
        removed = np.cumsum(covered[:-1]) > 0
        kept, n_removed, n_spans = [], [], []
        for a, b in zip(chunk.offs, chunk.offs[1:]):
            own = removed[a:b]
            kept.append(chunk.data[a:b][~own].tobytes())
            n_removed.append(int(own.sum()))
            n_spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
        return pa.table({"id": pa.array(chunk.ids, pa.int64()), "n_bytes": pa.array(np.diff(chunk.offs), pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
                         "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                         "kept": pa.array(kept, pa.binary())})
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                   keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row for
    each input row; ``kept`` is the remaining bytes, which need not be valid
    UTF-8."""
    if not 8 <= anchor < length or length - anchor + 1 > 64:
        raise ValueError("anchor must be at least 8 and length - 63, and less than length")
    rows = documents(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = shuffle_partitions(docs.sparkSession)
    chunks = max(parts, -(-total // chunk_bytes))
    bits = max(0, (max(parts, total // bucket_bytes) - 1).bit_length())
    texts = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)))
    sent = texts.groupBy("chunk").applyInArrow(
        _send_minimizers(bits, length, anchor), SENT)
    known = shared(sent)
    runs = texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _send_runs(bits, length, anchor),
        "bucket int, chunk long, prints binary, owners binary, sizes binary, bytes binary")
    masks = runs.groupBy("bucket").applyInArrow(_sort_bucket(length), "chunk long, bucket int, masks binary")
    none = F.lit(None).cast("binary")
    answers = known.withColumn("masks", none).unionByName(masks.withColumn("low", none))
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _cut(bits, length, anchor),
        "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = out.select(public_id().alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    return out if keep_bytes else out.drop("kept")
