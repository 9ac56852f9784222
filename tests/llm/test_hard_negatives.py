import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import hard_negatives
from tickforge.llm.hard_negatives import LARGEST, bounds, dot, hilbert, mine


def brute(rows, anchor, n_pos=5, n_neg=5, low=(80, 100)):
    """rows: (id, label, vector of ints); all scores of all anchors."""
    last = (1 << 63) - 1
    use = [(last if i is None else i, label, [max(-LARGEST, min(LARGEST, x)) for x in v]) for i, label, v in rows
           if label is not None and v and None not in v]
    sizes = sorted({len(v) for *_, v in use}, key=lambda d: (-sum(len(v) == d for *_, v in use), d))
    use = [r for r in use if len(r[2]) == sizes[0]] if sizes else []
    out = []
    for k, (i, label, v) in enumerate(use):
        if i == last or not anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for m, (j, other, w) in enumerate(use) if m != k)
        for p, j, _ in [s for s in scored if s[2] == label][:n_pos]:
            fit = [s for s in scored if s[2] != label and low[0] * -p <= low[1] * -s[0] <= low[1] * -p]
            out += [(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(fit[:n_neg])]
    return sorted(((a, None if b == last else b, r, None if n == last else n, p, s) for a, b, r, n, p, s in out), key=str)


def check(spark, rows, step=10, **how):
    df = spark.createDataFrame([(i, label, v, "x", 1) for i, label, v in rows],
                               "vec_id long, label int, vec array<long>, anchor string, block int")
    got = mine(df, F.col("vec_id") % step == 0, **how)
    want = brute(rows, lambda i: i % step == 0, **how)
    assert sorted(map(tuple, got.collect()), key=str) == want
    return want


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    for name, size in (("BLOCK", 16), ("CHUNK", 4), ("PAGE", 8)):
        monkeypatch.setattr(hard_negatives, name, size)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16)) * 40
    vecs = np.concatenate([rng.normal(size=(150, 16)) * 30] + [c + rng.normal(size=(25, 16)) * 6 for c in centres] + [
        np.repeat(centres[:1], 60, axis=0)])
    vecs = np.floor(vecs).astype(int).tolist()
    ids = rng.permutation(2 * len(vecs))[:len(vecs)].tolist()
    rows = [(i, int(rng.integers(0, 4)), v) for i, v in zip(ids, vecs)]
    assert len(check(spark, rows)) > 100
    check(spark, rows, n_pos=2, n_neg=9, low=(1, 3))


def test_odd_rows(spark):
    v = [3, 4, 0]
    rows = [(0, 1, v), (0, 1, v), (10, 1, v), (11, 2, v), (11, 2, v), (12, 2, [2, 4, 0]), (None, 1, v), (None, 2, v), (20, None, v),
            (30, 1, None), (40, 1, []), (50, 1, [1, None, 2]), (60, 1, [1, 2]), (70, 1, [10 ** 12, -10 ** 12, 0]), (80, 2, [0, 0, 0]),
            (90, 3, v), (13, 1, [-3, -4, 0])]
    assert check(spark, rows)
    assert check(spark, [(1, 1, v), (2, 2, v)]) == []
    df = spark.createDataFrame(rows, "vec_id long, label int, vec array<long>")
    assert mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert mine(df, F.lit(False)).count() == 0


def test_only_blocks_that_bounds_admit_are_read(spark, monkeypatch):
    """Groups far apart: an anchor's windows read the blocks of its group and
    few others."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 32)
    monkeypatch.setattr(hard_negatives, "CHUNK", 8)
    rng = np.random.default_rng(6)
    centres = np.eye(16)[:, :16] * 200
    rows = [(k, int(rng.integers(0, 3)), np.floor(centres[k % 16] + rng.normal(size=16) * 4).astype(int).tolist()) for k in range(3200)]
    seen = []
    real = hard_negatives.written

    def noted(df, label):
        out = real(df, label)
        if label in ("positives-blocks", "negatives-blocks"):
            seen.append(out)
        return out

    monkeypatch.setattr(hard_negatives, "written", noted)
    df = spark.createDataFrame(rows, "vec_id long, label int, vec array<long>")
    got = sorted(map(tuple, mine(df, F.col("vec_id") % 100 == 0).collect()), key=str)
    assert got == brute(rows, lambda i: i % 100 == 0)
    chosen = [x for x in seen if "chunk" in x.columns]
    chunks = chosen[0].select("chunk").distinct().count()
    assert len(chosen) == 2 and [x for x in (c.count() / (chunks * 100) for c in chosen) if x > 0.5] == []


def test_curve_and_bounds():
    """The curve visits every cell of a grid, each a neighbour of the last."""
    for dims, bits in ((2, 3), (3, 2), (5, 1)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hilbert(grid, bits)]
        path = grid[np.argsort(np.array(keys, dtype=object), kind="stable")]
        assert len(set(keys)) == len(grid)
        assert (np.abs(np.diff(path.astype(int), axis=0)).sum(1) == 1).all()
    rng = np.random.default_rng(0)
    rows, anchors = rng.integers(-9, 9, (50, 7)), rng.integers(-9, 9, (5, 7))
    low, high = bounds(anchors, rows.min(0, keepdims=True), rows.max(0, keepdims=True))
    scores = anchors @ rows.T
    assert (low[:, 0] <= scores.min(1)).all() and (high[:, 0] >= scores.max(1)).all()
    big = np.full((1, 4), LARGEST)
    assert dot(big, big)[0, 0] == 4 * LARGEST ** 2
