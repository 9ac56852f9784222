import random
import tracemalloc

import numpy as np
import pytest

from brute import sha
from tickforge.llm import suffix_dedup
from tickforge.llm.suffix_dedup import block_order, remove_repeats, smallest_owners


def brute(docs, length=50):
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k:k + length]] < i:
                gone[k:k + length] = [True] * length
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)

    def some(n, letters="abcdé "):
        return "".join(rng.choice(letters) for _ in range(n))

    parts = [some(rng.randrange(30, 200)) for _ in range(12)] + ["ab" * 80, "x" * 170, " " * 90, "é" * 40]
    docs = []
    for _ in range(60):
        t = "".join(rng.choice([some(rng.randrange(0, 90)), rng.choice(parts), rng.choice(parts)[3:-rng.randrange(1, 30)]])
                    for _ in range(rng.randrange(0, 8)))
        docs.append(t)
    docs += [docs[1], docs[1], "", "a", "x" * 49, "x" * 50, "x" * 51]
    rng.shuffle(docs)
    return list(enumerate(docs))


def rows(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("seed,chunk,bucket,block", [(1, 1 << 20, 1 << 20, 1 << 18), (2, 1000, 1000, 50), (3, 300, 100, 1)])
def test_equals_every_string(spark, monkeypatch, seed, chunk, bucket, block):
    monkeypatch.setattr(suffix_dedup.smallest_owners, "__defaults__", (block,))
    docs = texts(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(remove_repeats(df, chunk_bytes=chunk, bucket_bytes=bucket)) == brute(docs)


def test_other_lengths(spark):
    docs = texts(4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(remove_repeats(df, length=20, anchor=9)) == brute(docs, 20)


@pytest.mark.parametrize("letters", [b"a", b"ab", bytes(range(256))])
def test_block_order(letters):
    rng = random.Random(5)
    runs = [bytes(rng.choice(letters) for _ in range(rng.randrange(50, 77))) for _ in range(60)]
    runs += [x[2:] + b"a" * 10 for x in runs[:30]] + runs[:10]
    data, ends, at = b"", [], []
    for x in runs:
        at += range(len(data), len(data) + len(x) - 49)
        data += x
        ends += [len(data)] * len(x)
    order, classes = block_order(np.frombuffer(data, np.uint8), np.array(ends), np.array(at), 50, 84)
    strings = [data[i:i + 50] for i in order]
    assert strings == sorted(strings) and sorted(order) == at
    assert [a == b for a, b in zip(classes, classes[1:])] == [a == b for a, b in zip(strings, strings[1:])]


def test_odd_rows(spark):
    t = "some words that are long enough to be seen as a repeat, at last"
    docs = [(3, t, 1), (None, t + "é", 2), (3, t, 3), (None, None, 4), (2, None, 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, kept int")
    out = sorted(map(tuple, remove_repeats(df).drop("kept_sha256").collect()), key=str)
    assert out == sorted([(3, 63, 0, 0, t.encode()), (3, 63, 0, 0, t.encode()), (None, 65, 63, 1, "é".encode()),
                          (None, 0, 0, 0, b""), (2, 0, 0, 0, b"")], key=str)
    assert remove_repeats(df.limit(0)).count() == 0


def hot_runs(n, seed):
    """Runs of one minimizer in the middle; some share what stands around it."""
    rng = np.random.default_rng(seed)
    sizes = rng.integers(50, 77, n)
    before, after = rng.integers(97, 123, (40, 26), np.uint8), rng.integers(97, 123, (40, 26), np.uint8)
    anchor = rng.integers(97, 123, 24, np.uint8)
    rows = np.concatenate([before[rng.integers(0, 40, n)], np.tile(anchor, (n, 1)), after[rng.integers(0, 40, n)]], axis=1)
    other = rng.random(n) < 0.7
    rows[other, 50 + rng.integers(0, 26, other.sum())] = rng.integers(65, 91, other.sum(), np.uint8)
    data = np.concatenate([r[:s] for r, s in zip(rows, sizes)])
    return np.full(n, 7, np.uint64), rng.integers(0, n // 2, n), sizes, data


@pytest.mark.parametrize("block", [500, 5000, 60_000])
def test_one_hot_minimizer_equals_every_suffix(block):
    prints, owners, sizes, data = hot_runs(600, block)
    text, begins = data.tobytes(), np.cumsum(sizes) - sizes
    least = {}
    for o, s, b in zip(owners.tolist(), sizes.tolist(), begins.tolist()):
        for k in range(s - 49):
            key = text[b + k:b + k + 50]
            least[key] = min(least.get(key, o), o)
    want = [sum((least[text[b + k:b + k + 50]] < o) << k for k in range(s - 49))
            for o, s, b in zip(owners.tolist(), sizes.tolist(), begins.tolist())]
    assert sum(map(bool, want)) > 100
    assert smallest_owners(prints, owners, sizes, data, 50, block).tolist() == want


def test_memory_of_a_hot_minimizer_is_bounded():
    """100,000 distinct runs: what a run adds is its suffixes' hashes and
    numbers, under 1.5 KB; a block is as small as ever."""
    args = hot_runs(100_000, 1)
    tracemalloc.start()
    try:
        smallest_owners(*args, 50)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100_000 * 1500 + 250 * (1 << 20)
