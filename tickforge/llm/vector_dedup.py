"""Near-duplicate vectors: product quantisation over inverted lists.

Vectors with cosine >= ``threshold`` (0.9) are linked.

1. Equal vectors are one class; all below works on classes with their counts.
2. A model is fitted on a bounded sample (``SAMPLE`` rows by hash): centroids
   of coarse lists by spherical k-means, codebooks of 256 words for each eight
   dimensions of the residuals, and leaders (step 5).
3. Every vector is indexed in the list of its nearest centroid c as the code of
   its residual and the length e of what the code leaves out.  It probes each
   list that a neighbour may lie in.  If y with x . y = t is nearer to c' than
   to c, then x.c - x.c' <= sqrt(1 - t^2) / t * |c - c'| * cos(angle) for the
   angle between c' - c and the part of y across x.  Lists are probed up to the
   margin for a cosine of z / sqrt(d - 1), ``z`` standard deviations of a random
   direction in d dimensions (z = sqrt(d - 1) is the bound that holds always,
   and is what few dimensions get).  A pair is found from either side.
4. In a list, x . y <= x . y' + e for the coded y'; x . y' comes from a table
   of the query's products with the codebooks (asymmetric distances).  Pairs
   that pass are decided by their exact cosines in double precision.  So in the
   probed lists no link is lost.  Each list is cut into blocks of members and
   of queries by hash, so a task has one block of each, whatever the list's
   size.  A task returns, for each vector, the number of links, and a spanning
   forest of the links instead of the pairs.
5. Tight groups.  Around leaders (sample rows with at least ``CROWD`` sample
   rows within half the threshold's angle) all vectors within that angle are a
   ball: they are linked with each other without looking at pairs, and enter no
   list.  A vector outside can only be linked with members if it is within the
   threshold's angle and the ball's radius of the leader; if it is so near that
   all are, it is counted with the whole ball, else it is compared with the
   ball's members, in blocks.  A group of near copies that holds a third of all
   rows thus costs one row each.
6. Components of the forests' links; each gets its smallest id.

What is exact: no pair below the threshold is linked; all pairs of copies, of
ball members, and of vectors with a ball are found.  What depends on the
probes: pairs in lists that neither probes.  Measured recall against brute
force is in the README (0.99 and more at cosine 0.9, 1 above 0.93).

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; vectors of different lengths are not linked.  Repeated rows (and
repeated ids) are vectors like others, each with a row of its own; null ids
come after all others and stay null.  Columns other than the id and the vector
are not read.  An empty table gives no rows.

Memory: a task holds one block of members and queries.  The driver gets the
sample, the list sizes (at most ``MAX_LISTS`` rows) and the balls (at most
``SAMPLE / CROWD``), whatever the input's size; they are broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import LAST_ID, components, public_id, ship, written

THRESHOLD = 0.9
Z = 2.0
SAMPLE = 1 << 15
#: Sample rows that leaders are searched among, and neighbours that make one.
LEADER_SAMPLE, CROWD = 1 << 13, 8
LIST_ROWS, MAX_LISTS = 200, 1 << 12
CODE_DIMS, WORDS = 8, 256
#: Numbers (rows x dimensions) of a block of members and of one of queries.
BLOCK_NUMBERS = 1 << 18
EPS = 1e-6

ENCODED = ("key long, n long, vec binary, own int, probes binary, code binary, err float, ball int, angle double,"
           " shell binary, shell_angle binary")
FOUND = "key long, links long, other long"


@dataclass
class Model:
    dims: int
    kind: np.dtype
    threshold: float
    margin: float              # of a probe, for each unit of distance between centroids
    centroids: np.ndarray
    books: list[tuple[slice, np.ndarray]]
    leaders: np.ndarray


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def _means(rows: np.ndarray, n: int, spherical: bool, rng, rounds: int = 8) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(n, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(rows, centres, spherical)
        size = np.bincount(own, minlength=len(centres))
        order = np.argsort(own, kind="stable")
        some = np.flatnonzero(size)
        sums = np.add.reduceat(rows[order], (np.cumsum(size) - size)[some], axis=0)
        if spherical:
            length = np.sqrt((sums * sums).sum(1))
            centres[some[length > 0]] = sums[length > 0] / length[length > 0, None]
        else:
            centres[some] = sums / size[some, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray, spherical: bool) -> np.ndarray:
    half = 0 if spherical else (centres * centres).sum(1) / 2
    return np.concatenate([np.zeros(0, np.int64)] + [
        (rows[k:k + 4096] @ centres.T - half).argmax(1) for k in range(0, len(rows), 4096)])


def find_leaders(rows: np.ndarray, angle: float, crowd: int) -> np.ndarray:
    """Indices of rows with the most others within ``angle``, one after another
    among those that no earlier leader has."""
    near = np.concatenate([rows[k:k + 1024] @ rows.T >= math.cos(angle) for k in range(0, len(rows), 1024)])
    count = near.sum(1)
    found = []
    while len(count) and count.max() > crowd:
        lead = int(count.argmax())
        gone = near[lead].copy()
        found.append(lead)
        count = count - near[:, gone].sum(1)
        near[:, gone] = False
        count[gone] = 0
        near[gone] = False
    return np.array(found, np.int64)


def fit(sample: np.ndarray, n_rows: int, threshold: float = THRESHOLD, z: float = Z, crowd: int = CROWD) -> Model:
    """``sample``: vectors of one length; ``n_rows``: of the whole table."""
    rng = np.random.default_rng(13)
    dims = sample.shape[1]
    rows = unit(sample)
    half = math.acos(threshold) / 2 - EPS
    some = rows[:LEADER_SAMPLE]
    leaders = some[find_leaders(some, half, crowd)]
    if len(leaders):
        rest = rows[(rows @ leaders.T).max(1) < math.cos(half)]
        rows = rest if len(rest) >= WORDS else rows
    lists = max(1, min(n_rows // LIST_ROWS, MAX_LISTS, len(rows) // CROWD))
    centroids = _means(rows, lists, True, rng)
    residuals = (rows - centroids[_nearest(rows, centroids, True)])[:1 << 14]
    books = []
    for k in range(0, dims, CODE_DIMS):
        part = slice(k, min(k + CODE_DIMS, dims))
        books.append((part, _means(residuals[:, part], WORDS, False, rng).astype(np.float32)))
    margin = math.sqrt(1 - threshold ** 2) / threshold * min(1.0, z / math.sqrt(max(dims - 1, 1)))
    return Model(dims, sample.dtype, threshold, margin, centroids, books, leaders)


def _packed(counts: np.ndarray, flat: np.ndarray) -> pa.Array:
    """Binary values: each row's slice of ``flat``."""
    ends = np.cumsum(counts) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [
        None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def encode(model: Model, vectors: np.ndarray) -> dict[str, pa.Array]:
    n = len(vectors)
    rows = unit(vectors)
    if len(model.leaders):
        to_leaders = angles(rows @ model.leaders.T)
        ball, angle = to_leaders.argmin(1), to_leaders.min(1)
        limit = math.acos(model.threshold)
        ball[angle > limit / 2 - EPS] = -1
        shell = to_leaders <= 1.5 * limit + EPS
        shell[np.arange(n), ball] &= ball < 0
    else:
        ball, angle, shell, to_leaders = np.full(n, -1), np.zeros(n), np.zeros((n, 0), bool), np.zeros((n, 0))
    sims = rows @ model.centroids.T
    own = sims.argmax(1)
    between = np.sqrt(np.maximum(0, 2 - 2 * model.centroids @ model.centroids.T))
    probes = (sims.max(1)[:, None] - sims <= model.margin * between[own]) & (ball < 0)[:, None]
    residual = rows - model.centroids[own]
    code = np.stack([_nearest(residual[:, part], book.astype(np.float64), False) for part, book in model.books], 1)
    for k, (part, book) in enumerate(model.books):
        residual[:, part] -= book[code[:, k]]
    err = np.sqrt((residual * residual).sum(1)) + 1e-4  # and more than single precision can be off
    return {"own": pa.array(np.where(ball < 0, own, -1), pa.int32()),
            "probes": _packed(probes.sum(1), np.nonzero(probes)[1].astype(np.int32)),
            "code": _packed(np.full(n, code.shape[1]), code.astype(np.uint8).ravel()),
            "err": pa.array(err, pa.float32()), "ball": pa.array(ball, pa.int32()), "angle": pa.array(angle),
            "shell": _packed(shell.sum(1), np.nonzero(shell)[1].astype(np.int32)),
            "shell_angle": _packed(shell.sum(1), to_leaders[shell])}


def _matrix(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that each of n nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if np.array_equal(low, high):
            return label
        np.minimum.at(label, high, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def _linked(q_rows: np.ndarray, m_rows: np.ndarray, threshold: float, may: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, member) with cosine >= threshold among those that
    ``may`` marks (None: all)."""
    if may is None or np.count_nonzero(may) > 0.02 * may.size:
        cos = q_rows @ m_rows.T
        i, j = np.nonzero((cos >= threshold - 1e-9) & (True if may is None else may))
        cos = cos[i, j]
    else:
        i, j = np.nonzero(may)
        cos = np.zeros(0)
        step = max(1, BLOCK_NUMBERS * 16 // m_rows.shape[1])
        cos = np.concatenate([cos] + [np.einsum("ij,ij->i", q_rows[i[k:k + step]], m_rows[j[k:k + step]])
                                      for k in range(0, len(i), step)])
    # near the threshold the same sum decides from either side
    edge = np.flatnonzero(np.abs(cos - threshold) < 1e-9)
    cos[edge] = np.einsum("ij,ij->i", q_rows[i[edge]], m_rows[j[edge]])
    good = cos >= threshold
    return i[good], j[good]


def search(sent, coded: bool):
    """A block of queries against one of members; ``coded``: in a list, where
    what both sides find is counted from each side, else with a ball."""

    def run(key, rows):
        model = sent.value
        query = rows.column("query").to_numpy().astype(bool)
        keys, n = rows.column("key").to_numpy(), rows.column("n").to_numpy()
        vecs = unit(_matrix(rows.column("vec"), model.kind)) if len(rows) else np.zeros((0, model.dims))
        q, m = np.flatnonzero(query), np.flatnonzero(~query)
        links = np.zeros(len(rows), np.int64)
        ends_a, ends_b = [], []
        if len(q) and len(m):
            q_rows, m_rows = vecs[q], vecs[m]
            if coded:
                centroid = model.centroids[key[0].as_py()].astype(np.float32)
                members = rows.filter(pa.array(~query))
                codes, err = _matrix(members.column("code"), np.uint8), members.column("err").to_numpy()
                lists, own = np.unique(rows.column("own").to_numpy()[q], return_inverse=True)
                probes = [np.frombuffer(x, np.int32) for x in members.column("probes").to_pylist()]
                at = np.repeat(np.arange(len(m)), [len(x) for x in probes])
                flat = np.concatenate(probes)
                place = np.minimum(np.searchsorted(lists, flat), len(lists) - 1)
                back = np.zeros((len(m), len(lists)), bool)  # does the member find the query by itself?
                back[at, place] = lists[place] == flat
            step = max(1, (1 << 21) // len(m))
            for k in range(0, len(q), step):
                part = q_rows[k:k + step]
                may = None
                if coded:
                    single = part.astype(np.float32)
                    bound = (single @ centroid)[:, None] + err[None, :]
                    for s, (dims, book) in enumerate(model.books):
                        bound += np.take(single[:, dims] @ book.T, codes[:, s], axis=1)
                    may = bound >= model.threshold
                    may &= keys[q[k:k + step]][:, None] != keys[m][None, :]
                i, j = _linked(part, m_rows, model.threshold, may)
                i += k
                np.add.at(links, q[i], n[m[j]])
                other = ~back[j, own[i]] if coded else slice(None)
                np.add.at(links, m[j[other]], n[q[i[other]]])
                label = forest(q[i], m[j], len(rows))
                moved = np.flatnonzero(label != np.arange(len(rows)))
                ends_a.append(keys[moved])
                ends_b.append(keys[label[moved]])
        some = np.flatnonzero(links)
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (ends_a, ends_b))
        different = a != b
        a, b = a[different], b[different]
        return pa.table({"key": np.concatenate([keys[some], a]),
                         "links": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
                         "other": pa.array(np.concatenate([some, b]), pa.int64(), mask=np.arange(len(some) + len(b)) < len(some))})
    return run


def _blocks(members: DataFrame, queries: DataFrame, by: str, rows: int) -> DataFrame:
    """Members and queries of each ``by`` in blocks of about ``rows`` rows;
    each block of the one meets each of the other.  The sizes, one row for
    each list or ball, are small enough to broadcast."""
    size = F.greatest(F.lit(1), F.ceil(F.count("*") / rows)).cast("int")
    sizes = members.groupBy(by).agg(size.alias("nm")).join(queries.groupBy(by).agg(size.alias("nq")), by)
    sizes = F.broadcast(written(sizes, "vector-sizes"))
    place = F.xxhash64("key")

    def dealt(side, own, n_own, other, n_other, flag):
        return side.join(sizes, by).withColumn(own, F.pmod(place, F.col(n_own)).cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))) \
            .select(by, "mb", "qb", F.lit(flag).alias("query"), "key", "n", "vec", "own",
                    *[(F.lit(None).cast(t) if flag else F.col(c)).alias(c)
                      for c, t in (("probes", "binary"), ("code", "binary"), ("err", "float"))])

    return dealt(members, "mb", "nm", "qb", "nq", False).unionByName(dealt(queries, "qb", "nq", "mb", "nm", True))


def _links(classes: DataFrame, dims: int, n_rows: int, kind: np.dtype, threshold: float, z: float, crowd: int) -> DataFrame:
    """FOUND rows for classes (key, n, vec) of one length."""
    spark = classes.sparkSession
    every = -(-n_rows // SAMPLE)
    drawn = classes.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("vec").toArrow().column("vec")
    flat = drawn.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
    sample = flat.reshape(-1, dims)
    model = fit(sample if len(sample) else np.ones((1, dims), kind), n_rows, threshold, z, crowd)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                vectors = part.column("vec").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)
                made = encode(sent.value, vectors)
                yield pa.RecordBatch.from_pydict({"key": part.column("key"), "n": part.column("n"), "vec": _packed(
                    np.full(len(vectors), dims), vectors.ravel()), **made})

    coded = written(classes.mapInArrow(run, ENCODED), "vector-codes")
    rows = max(256, BLOCK_NUMBERS // dims)
    # lists
    members = coded.where("own >= 0").withColumn("list", F.col("own"))
    queries = coded.where("own >= 0").mapInArrow(_spread("probes", None), "list int, key long, n long, vec binary, own int")
    found = _blocks(members, queries, "list", rows).groupBy("list", "mb", "qb").applyInArrow(search(sent, True), FOUND)
    found = written(found, "vector-links")
    if not len(model.leaders):
        return found
    # balls
    inside = coded.where("ball >= 0")
    limit = math.acos(threshold)
    balls = written(inside.groupBy("ball").agg(F.sum("n").alias("size"), F.max("angle").alias("radius"),
                                               F.min("key").alias("first")), "vector-balls")
    around = coded.where("length(shell) > 0").mapInArrow(
        _spread("shell", "shell_angle"), "list int, key long, n long, vec binary, own int, ball int, angle double") \
        .withColumnRenamed("ball", "mine").withColumnRenamed("list", "ball") \
        .join(F.broadcast(balls), "ball").where(F.col("mine") < F.col("ball")) \
        .where(F.col("angle") <= limit + F.col("radius") + EPS)
    around = written(around, "vector-shells")
    whole = F.col("angle") + F.col("radius") <= limit - EPS
    near = around.where(whole)
    credit = near.groupBy("ball").agg(F.sum("n").alias("more"))
    own = inside.join(F.broadcast(balls), "ball").join(credit, "ball", "left").select(
        "key", (F.col("size") - F.col("n") + F.coalesce("more", F.lit(0))).alias("links"), F.col("first").alias("other"))
    near = near.select("key", F.col("size").alias("links"), F.col("first").alias("other"))
    partly = _blocks(inside, around.where(~whole), "ball", rows).groupBy("ball", "mb", "qb") \
        .applyInArrow(search(sent, False), FOUND)
    return found.unionByName(own).unionByName(near).unionByName(written(partly, "vector-ball-links"))


def _spread(column: str, values: str | None):
    """One row for each number in a binary column of ints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                lists = batch.column(column).to_pylist()
                at = pa.array(np.repeat(np.arange(len(lists)), [len(x) // 4 for x in lists]), pa.int64())
                out = {"list": pa.array(np.frombuffer(b"".join(lists), np.int32), pa.int32())}
                for c in ("key", "n", "vec", "own", *(["ball"] if values else [])):
                    out[c] = batch.column(c).take(at)
                if values:
                    out["angle"] = pa.array(np.frombuffer(b"".join(batch.column(values).to_pylist()), np.float64))
                yield pa.RecordBatch.from_pydict(out)

    return run


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 z: float = Z, crowd: int = CROWD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each input row."""
    spark = rows.sparkSession
    ship(spark)
    vec = F.col(f"`{vector_col}`")
    single = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    keyed = rows.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
                        vec.cast("array<float>" if single else "array<double>").alias("vec"),
                        F.monotonically_increasing_id().alias("key"))
    good = F.expr("vec is not null and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
                  " and exists(vec, x -> x != 0)")
    plain = F.transform("vec", lambda x: x + F.lit(0).cast("float" if single else "double"))  # -0.0 is 0.0
    keyed = written(keyed.withColumn("vec", F.when(good, plain)).withColumns(
        {"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(13), "vec"), "good": F.col("vec").isNotNull()}), "vectors")
    classes = written(keyed.where("good").groupBy("vec").agg(F.min("key").alias("key"), F.count("*").alias("n"),
                                                            F.min("h1").alias("h1"), F.min("h2").alias("h2")), "vector-classes")
    lengths = classes.groupBy(F.size("vec").alias("dims")).count().where("count > 1").collect()
    nothing = spark.createDataFrame([], FOUND)
    found = nothing
    for dims, n_rows in sorted(lengths):
        found = found.unionByName(_links(classes.where(F.size("vec") == dims), dims, n_rows,
                                         np.dtype(np.float32 if single else np.float64), threshold, z, crowd))
    roots = components(found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b")),
                       classes.select(F.col("key").alias("id")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    judged = written(classes.join(links, "key", "left").join(roots.withColumnRenamed("id", "key"), "key").select(
        F.col("key").alias("class"), "h1", "h2", "root", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "vector-classes-judged")
    placed = written(keyed.select("id", "key", "h1", "h2", "good").join(judged.withColumn("good", F.lit(True)), ["h1", "h2", "good"], "left")
                     .select("id", "key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                             F.coalesce("root", "key").alias("root")), "vectors-judged")
    least = placed.groupBy("root").agg(F.min("id").alias("least"))
    return placed.join(least, "root").select(
        public_id().alias(id_col), "n_links", public_id("least").alias("component_id"),
        (F.col("id") == F.col("least")).alias("kept"))
