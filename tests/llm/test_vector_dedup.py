import math

import numpy as np
import pytest

from tickforge.llm import vector_dedup
from tickforge.llm.vector_dedup import fit, near_vectors


def brute(rows, threshold=0.9):
    """{row number: (links, smallest id reached, None last)}"""
    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    use = [k for k, (_, v) in enumerate(rows) if good(v)]
    links = {k: set() for k in range(len(rows))}
    for dims in {len(rows[k][1]) for k in use}:
        same = [k for k in use if len(rows[k][1]) == dims]
        m = np.array([rows[k][1] for k in same], np.float64)
        m /= np.abs(m).max(1, keepdims=True)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        cos = m @ m.T
        for a, b in zip(*np.nonzero(cos >= threshold)):
            if a != b:
                links[same[a]].add(same[b])
    root, out = {}, {}
    for k in sorted(links, key=lambda k: (rows[k][0] is None, rows[k][0])):
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = rows[k][0]
                todo += links[x]
    return {k: (len(links[k]), root[k]) for k in links}


def compare(spark, rows, kind="float", **how):
    df = spark.createDataFrame([(k, i, v, "x") for k, (i, v) in enumerate(rows)],
                               f"n long, vec_id long, embedding array<{kind}>, key string")
    got = near_vectors(df, **how).collect()
    want = brute([(r.vec_id, r.embedding) for r in df.orderBy("n").collect()])
    expected = sorted((i is None, i or 0, n, c is None, c or 0, i == c) for (i, _), (n, c) in zip(rows, (want[k] for k in range(len(rows)))))
    assert sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id is None, r.component_id or 0, r.kept) for r in got) == expected


def around(rng, centre, noise, n):
    return centre + noise * rng.normal(size=(n, len(centre)))


def corpus(seed, dims=32):
    """Random vectors, tight and loose groups, chains of links."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(500, dims))]
    parts += [around(rng, rng.normal(size=dims), noise, n) for noise, n in ((0.05, 300), (0.3, 120), (0.42, 60), (0.2, 9))]
    step = rng.normal(size=dims)
    parts.append(np.array([math.cos(a) * parts[0][0] / np.linalg.norm(parts[0][0]) + math.sin(a) * step for a in np.arange(0, 1, 0.05)]))
    return [[float(x) for x in v] for v in np.concatenate(parts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    vecs = corpus(seed)
    ids = np.random.default_rng(seed).permutation(5 * len(vecs))[:len(vecs)].tolist()
    compare(spark, list(zip(ids, vecs)))
    compare(spark, list(zip(ids, vecs)), z=math.inf, crowd=10 ** 6)  # all probes, no balls


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0, 0.0]
    rows = [(5, v), (3, v), (3, v), (None, v), (9, None), (8, []), (7, [0.0] * 4), (6, [1.0, None, 3.0, 0.0]),
            (10, [math.nan, 1.0, 2.0, 3.0]), (11, [math.inf, 1.0, 2.0, 3.0]), (12, [x * 1e300 for x in v]), (13, [1.0, 2.0, 3.0]),
            (14, [2.0, 4.0, 6.0]), (15, [1.0, 2.0, 3.0, -0.0]), (16, [-1.0, -2.0, -3.0, 0.0]), (None, None), (17, [5.0])]
    compare(spark, rows, "double")
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert near_vectors(df.limit(0)).count() == 0


def test_hot_groups_in_blocks(spark, monkeypatch):
    """A list and a ball that each hold a third of the rows, cut into small blocks."""
    monkeypatch.setattr(vector_dedup, "BLOCK_NUMBERS", 256 * 32)
    rng = np.random.default_rng(4)
    vecs = np.concatenate([around(rng, rng.normal(size=32), 0.05, 1000), around(rng, rng.normal(size=32), 0.36, 1000),
                           rng.normal(size=(1000, 32))])
    compare(spark, [(k, [float(x) for x in v]) for k, v in enumerate(vecs)])


def test_recall_at_the_threshold():
    """Pairs of random directions at the smallest cosine: the share that either probes."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    y = 0.9 * x + math.sqrt(0.19) * u / np.linalg.norm(u, axis=1, keepdims=True)
    for n in (20_000, 10 ** 9):
        model = fit(x[:8000].astype(np.float32), n)
        sides = []
        for a in (x, y):
            sims = a @ model.centroids.T
            own = sims.argmax(1)
            between = np.sqrt(np.maximum(0, 2 - 2 * model.centroids @ model.centroids.T))
            sides.append((own, sims.max(1)[:, None] - sims <= model.margin * between[own]))
        (own_x, by_x), (own_y, by_y) = sides
        at = np.arange(len(x))
        assert (by_x[at, own_y] | by_y[at, own_x]).mean() >= 0.99
