"""Near-duplicate documents by circulant MinHash.

Signature.  Two permutations of the 32-bit integers make all coordinates: the
first, sigma, spreads the shingles; coordinate k is the minimum of the second,
pi, after a circular shift by k: ``min pi((sigma(s) - k) mod 2**32)``.  Bands of
``ROWS`` coordinates give candidate buckets.  With 24 bands of 4 a pair of
similarity 0.85 shares no bucket with probability 2e-8, of 0.8 with 3e-6.

Links.  Every link is confirmed on the full shingle sets, and no group is
expanded into all its pairs:

1. Texts with equal shingle sets are one class, a node of the graph; a text of
   its smallest id stands for it.
2. Each bucket has a pivot, the member that shares most buckets (the most
   central one).  Each member is compared with its pivots; components of these
   links are formed.
3. Buckets whose members are in one component are done.  Members of different
   components of a bucket may still be linked past their pivot c.  In buckets
   of up to ``SMALL`` members those pairs are compared.  In larger buckets two
   sets x, y are looked at through their differences from the pivot,
   D(x) = x ^ c.  As x ^ y = D(x) ^ D(y), a link needs
   ``|D(x) & D(y)| >= (|D(x)| + |D(y)| - T) / 2`` with
   ``T = (1 - t) / (1 + t) * (|x| + |y|)``, and at least one common element:
   with none, J(x, y) <= J(x, c) and J(y, c), so both would be linked with c.
   So an index over the first elements of each D in one order, rare ones first
   (a prefix filter), finds all such pairs.  In a group of near copies these are
   each copy's own edits, so the index stays sparse however large the group is.
4. The links found in 2 and 3 give the components.

Empty texts have no shingles and are linked with nothing.  A text with fewer
than five words has one shingle.  A null text is empty.  Each row is judged by
its own text, also where rows repeat an id: different texts of one id are different
nodes, so an id never links them.  Rows that repeat the smallest id of their
component stay.  Null ids come last and count as one id.  Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.arrowtext import U64, mix, pieces, text_shingles
from tickforge.llm.common import components, documents, public_id, shuffle_partitions, written
from tickforge.llm.sharedkeys import SENT, is_shared, send, shared

BANDS, ROWS = 24, 4
SMALL = 32
THRESHOLD_PCT = 80

U32 = np.uint32


def _mix32(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit integers."""
    x = x ^ (x >> U32(16))
    x = x * U32(a)
    x = x ^ (x >> U32(15))
    x = x * U32(b)
    return x ^ (x >> U32(16))


def signatures(h: np.ndarray, offs: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: (texts with shingles) x size."""
    sigma = _mix32((h >> U64(32)).astype(U32), 0x7FEB352D, 0x846CA68B)
    out = np.empty((len(offs) - 1, size), U32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_mix32(sigma - U32(k), 0x21F0AAAD, 0xD35A2D97), offs[:-1])
    return out


def band_keys(h: np.ndarray, offs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts with shingles) x bands, 64-bit."""
    sig = signatures(h, offs, bands * rows).astype(U64).reshape(-1, bands, rows)
    key = np.tile(np.arange(bands, dtype=U64), (len(sig), 1))
    for j in range(rows):
        key = mix(key * U64(0x9E3779B97F4A7C15) + sig[:, :, j])
    return key


def _sketch(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                h, offs, _ = text_shingles(piece.column("text"))
                own = [np.unique(h[a:b]) for a, b in zip(offs[:-1], offs[1:])]
                n = np.array([len(x) for x in own])
                some = np.flatnonzero(n)
                one, two = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                keys = np.zeros((0, bands), U64)
                if len(some):
                    flat = np.concatenate([own[i] for i in some])
                    at = np.concatenate([[0], np.cumsum(n[some])])
                    one[some] = np.add.reduceat(mix(flat ^ U64(0x1234567)), at[:-1]).view(np.int64)
                    two[some] = np.add.reduceat(mix(flat ^ U64(0x89ABCDE)), at[:-1]).view(np.int64)
                    keys = band_keys(flat, at, bands, rows)
                ends = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("version"), pa.array(n.astype(np.int64)), pa.array(one), pa.array(two),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64)))],
                    names=["id", "version", "n", "s1", "s2", "keys"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            h, offs, _ = text_shingles(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array([np.unique(h[a:b]).tobytes() for a, b in zip(offs[:-1], offs[1:])],
                                              pa.binary())], names=["id", "set"])


def _rows(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(x).to_pylist() for x in names))


def _compare(pct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "xs", 1 << 22):
                xs, cs, ok = [], [], []
                for x, c, a, b in _rows(piece, "x", "c", "xs", "cs"):
                    a, b = np.frombuffer(a, U64), np.frombuffer(b, U64)
                    both = len(np.intersect1d(a, b, True))
                    xs.append(x)
                    cs.append(c)
                    ok.append(100 * both >= pct * (len(a) + len(b) - both))
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(cs, pa.int64()),
                                                  pa.array(ok, pa.bool_())], names=["x", "c", "linked"])
    return run


def _differences(pct: int):
    """x ^ c of each member x of a group around c, as two lists: the elements
    that x adds to c, and those that it lacks.  The latter are common in the
    group and come last in the index's order; only the ones within the prefix
    are kept.  ``top`` is the last place in the prefix."""
    names = ["c", "x", "root", "near", "nx", "nd", "top", "new", "lost"]
    tau, more = (100 - pct) / (100 + pct), (100 - pct) / pct

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "xs", 1 << 20):
                cols: list[list] = [[] for _ in names]
                for x, c, a, b, root, near in _rows(piece, "x", "c", "xs", "cs", "root", "near"):
                    a, b = np.frombuffer(a, U64), np.frombuffer(b, U64)
                    new, lost = np.setdiff1d(a, b, True), np.setdiff1d(b, a, True)
                    nx, nc, nd = len(a), len(b), len(new) + len(lost)
                    # the least overlap with any partner; rounding stays on the safe side
                    if near and nd <= tau * (nx + nc):
                        least = np.ceil((nd + tau * (nc - nx)) / 2 - 1e-6)
                    else:
                        most = np.floor(more * nx + 1e-9)
                        least = np.ceil((nd + max(nd - most, 0) - most) / 2 - 1e-6)
                    top = nd - max(1, int(least))
                    lost = lost[:max(0, top + 1 - len(new))]
                    for col, v in zip(cols, (c, x, root, near, nx, nd, top, new.tobytes(), lost.tobytes())):
                        col.append(v)
                kinds = {"near": pa.bool_(), "new": pa.binary(), "lost": pa.binary()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, kinds.get(n, pa.int64())) for v, n in zip(cols, names)], names=names)
    return run


def _group_keys(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the members' added elements, each one's member, each one's key in its
    group)."""
    new = [np.frombuffer(x, U64) for x in rows.column("new").to_pylist()]
    member = np.repeat(np.arange(len(new)), [len(x) for x in new])
    token = np.concatenate([*new, np.zeros(0, U64)])
    group = rows.column("c").to_numpy().astype(np.int64).view(U64)
    return token, member, mix(token ^ mix(group[member]))


def _send_keys(bits: int):
    def run(key, rows):
        _, member, keys = _group_keys(rows)
        return send(key[0].as_py(), keys, rows.column("x").to_numpy()[member], bits)
    return run


def _index_rows(bits: int):
    """A row for each added element that another member has as well (place -1:
    not known yet), and for each lacking one of the prefix."""
    names = ["c", "x", "root", "near", "nx", "nd", "top", "added", "token", "pos"]

    def run(key, rows, marks):
        token, member, keys = _group_keys(rows)
        some = is_shared(keys, marks, bits)
        added = np.bincount(member, minlength=rows.num_rows)
        lost = [np.frombuffer(x, U64) for x in rows.column("lost").to_pylist()]
        n = [len(x) for x in lost]
        who = np.concatenate([member[some], np.repeat(np.arange(len(lost)), n)]).astype(np.int64)
        tokens = np.concatenate([token[some], *lost]).view(np.int64)
        place = np.concatenate([np.full(int(some.sum()), -1), *[a + np.arange(k) for a, k in zip(added, n)]])
        cols = [rows.column(x).to_numpy(zero_copy_only=False)[who] for x in names[:7]]
        kinds = {"near": pa.bool_()}
        return pa.table({x: pa.array(v, kinds.get(x, pa.int64())) for x, v in
                         zip(names, [*cols, added[who], tokens, place.astype(np.int64)])})
    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, c, xs, cs)."""
    return pairs.join(sets.select(F.col("id").alias("x"), F.col("set").alias("xs")), "x") \
        .join(sets.select(F.col("id").alias("c"), F.col("set").alias("cs")), "c")


def _confirmed(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """(x, c, linked)."""
    return _with_sets(pairs, sets).select("x", "c", "xs", "cs").mapInArrow(
        _compare(pct), "x long, c long, linked boolean")


def _past_pivots(groups: DataFrame, sets: DataFrame, roots: DataFrame, pct: int) -> DataFrame:
    """Pairs (x, c) of different components to compare, from large groups
    (c, x) around a pivot; see the module's step 3."""
    tau = (100 - pct) / (100 + pct)
    rooted = groups.join(roots.select(F.col("id").alias("x"), "root"), "x") \
        .join(roots.select(F.col("id").alias("c"), F.col("root").alias("croot")), "c") \
        .select("x", "c", "root", (F.col("root") == F.col("croot")).alias("near"))
    members = written(_with_sets(rooted, sets).select("x", "c", "xs", "cs", "root", "near").mapInArrow(
        _differences(pct), "c long, x long, root long, near boolean, nx long, nd long, top long, new binary,"
                           " lost binary"), "near-differences")
    # members in chunks of about a thousand; what only one has needs no row
    parts = shuffle_partitions(groups.sparkSession)
    chunks = max(parts, -(-members.count() // 1024))
    bits = (parts - 1).bit_length()
    dealt = members.withColumn("chunk", F.pmod(F.xxhash64("c", "x"), F.lit(chunks)))
    known = shared(dealt.groupBy("chunk").applyInArrow(_send_keys(bits), SENT))
    rows = written(dealt.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _index_rows(bits), "c long, x long, root long, near boolean, nx long, nd long, top long, added long,"
                           " token long, pos long"), "near-elements")
    # added elements come first, the rarer the earlier; those that no other
    # member has need no row, but keep their places
    new = rows.where("pos < 0")
    df = new.groupBy("c", "token").agg(F.count("*").alias("df")).where("df > 1")
    member = Window.partitionBy("c", "x")
    several = new.join(df, ["c", "token"]).withColumn(
        "pos", F.col("added") - F.count("*").over(member) + F.row_number().over(member.orderBy("df", "token")) - 1)
    index = written(several.drop("df").unionByName(rows.where("pos >= 0")).where("pos <= top")
                    .select("c", "token", "x", "nx", "nd", "pos", "root", "near"), "near-index")
    a, b = index.where(~F.col("near")).alias("a"), index.alias("b")
    need: Column = F.greatest(F.lit(1), F.ceil(
        (F.col("a.nd") + F.col("b.nd") - F.lit(tau) * (F.col("a.nx") + F.col("b.nx"))) / 2 - 1e-6))
    met = a.join(b, (F.col("a.c") == F.col("b.c")) & (F.col("a.token") == F.col("b.token"))
                 & (F.col("a.root") != F.col("b.root")) & (F.col("b.near") | (F.col("a.x") < F.col("b.x")))
                 & (F.col("a.pos") <= F.col("a.nd") - need) & (F.col("b.pos") <= F.col("b.nd") - need))
    return met.select(F.col("a.x").alias("x"), F.col("b.x").alias("c")).distinct()


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = THRESHOLD_PCT,
              bands: int = BANDS, rows: int = ROWS, small: int = SMALL) -> DataFrame:
    """(id, version, n_shingles, root), one row for each input row: version is
    the text's xxhash64, root the smallest id reachable."""
    texts = documents(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))
    sig = written(texts.mapInArrow(
        _sketch(bands, rows), "id long, version long, n long, s1 long, s2 long, keys array<long>"), "near-signatures")
    full = sig.where("n > 0")
    # aggregates that are joined back are written first: both sides of such a
    # join are then dealt for it, and Spark can split a hot key
    classes = written(full.groupBy("s1", "s2", "n").agg(F.min(F.struct("id", "version")).alias("rep"))
                      .select("s1", "s2", "n", F.col("rep.id").alias("rep"), F.col("rep.version").alias("version"),
                              F.monotonically_increasing_id().alias("node")), "near-classes")
    same = ["s1", "s2", "n", "id", "version"]
    owners = full.join(classes.withColumnRenamed("rep", "id"), same).dropDuplicates(same).select(
        F.col("node").alias("id"), "keys")
    entries = owners.select(F.explode("keys").alias("key"), "id")
    counts = written(entries.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("lo"), F.max("id").alias("hi"))
                     .where("lo < hi").select("key", "m"), "near-counts")
    met = written(entries.join(counts, "key"), "near-buckets")
    central = met.groupBy("id").agg(F.sum("m").alias("score"))
    scored = met.join(central, "id")
    pivots = written(scored.groupBy("key").agg(F.max(F.struct("score", (-F.col("id")).alias("neg"))).alias("p"))
                     .select("key", (-F.col("p.neg")).alias("c")), "near-centres")
    placed = written(met.join(pivots, "key").select("key", "id", "m", "c"), "near-pivots")
    pairs = placed.where("id != c").select(F.col("id").alias("x"), "c").distinct()
    wanted = written(met.select("id").distinct(), "near-wanted")
    places = wanted.withColumnRenamed("id", "node").join(classes, "node").select(F.col("rep").alias("id"), "version", "node")
    sets = written(texts.join(places, ["id", "version"]).select(F.col("node").alias("id"), "text")
                   .mapInArrow(_sets, "id long, set binary"), "near-sets")
    links = written(_confirmed(pairs, sets, pct), "near-links")
    roots = written(components(links.where("linked").select(F.col("x").alias("a"), F.col("c").alias("b")), wanted),
                    "near-roots")

    # buckets with members of more than one component
    rooted = placed.join(roots, "id")
    mixed = written(rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                    .where("lo < hi").select("key"), "near-mixed")
    open_rows = written(rooted.join(mixed, "key", "left_semi"), "near-open")
    few = open_rows.where((F.col("m") > 2) & (F.col("m") <= small))
    a, b = few.alias("a"), few.alias("b")
    close = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id"))
                   & (F.col("a.root") != F.col("b.root"))) \
        .where("a.id != a.c and b.id != b.c").select(F.col("a.id").alias("x"), F.col("b.id").alias("c")).distinct()
    groups = open_rows.where((F.col("m") > small) & (F.col("id") != F.col("c"))) \
        .select("c", F.col("id").alias("x")).distinct()
    further = written(close.union(_past_pivots(groups, sets, roots, pct)).distinct(), "near-further")
    more = _confirmed(further, sets, pct).where("linked")
    lead = roots.select(F.col("id").alias("x"), F.col("root").alias("a"))
    bridges = written(more.join(lead, "x").join(lead.select(F.col("x").alias("c"), F.col("a").alias("b")), "c")
                      .select("a", "b").distinct(), "near-bridges")
    tops = components(bridges, roots.select(F.col("root").alias("id")).distinct())
    final = written(roots.join(tops.select(F.col("id").alias("root"), F.col("root").alias("top")), "root")
                    .select(F.col("id").alias("node"), "top").join(classes.select("node", "rep"), "node"), "near-final")
    least = written(final.groupBy("top").agg(F.min("rep").alias("least")), "near-least")
    found = final.join(least, "top").select("node", "least")
    return sig.join(classes.select("s1", "s2", "n", "rep", "node"), ["s1", "s2", "n"], "left").join(found, "node", "left") \
        .select("id", "version", F.col("n").alias("n_shingles"), F.coalesce("least", "rep", "id").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pct: int = THRESHOLD_PCT,
                    bands: int = BANDS, rows: int = ROWS, small: int = SMALL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each input row:
    documents with ``100 * shared >= pct * union`` five-word shingles are
    linked; component_id is the smallest id reachable."""
    return decisions(docs, id_col, text_col, pct, bands, rows, small).select(
        public_id().alias(id_col), "n_shingles", public_id("root").alias("component_id"),
        (F.col("id") == F.col("root")).alias("kept"))
