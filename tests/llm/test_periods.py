import random
import re
import zlib

import numpy as np
import pytest

from brute import sha
from tickforge.llm.periods import collapse, runs
from tickforge.llm.queries import op12_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length=6, min_exponent=4):
    """Every lag, every maximal stretch; the smallest lag of a stretch counts."""
    seen = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def stretch(rng):
    base = [rng.randrange(rng.choice([2, 5, 1000])) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 64, 70]))]
    words = [base[i % len(base)] for i in range(rng.randrange(1, len(base) * 6))]
    if rng.random() < 0.3:
        words[rng.randrange(len(words))] = 77777
    return words


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_of_several_texts_at_once(seed):
    rng = random.Random(seed)
    for _ in range(40):
        docs = [[rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(0, 150))] if rng.random() < 0.3 else
                [w for _ in range(rng.randrange(0, 4)) for w in stretch(rng)] for _ in range(rng.randrange(1, 5))]
        words = np.array([w for d in docs for w in d], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        text, *found = runs(words, np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64))
        for k, d in enumerate(docs):
            assert list(zip(*(v[text == k].tolist() for v in found))) == brute_runs(d)


def test_query_equals_plain_python(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{x}" for _ in range(rng.randrange(0, 4)) for x in stretch(rng))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (None, "a a a a a a b"), (None, None), (1003, "x " * 9000),
             (1004, "A a A a A a A a A"), (1005, "one\ttwo\x0bthree  four"), (1003, "x y"), (1003, "x y"),
             (1006, " ".join(f"v{i % 1700}" for i in range(20000))), (1007, "é é é é é é  é")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as n", "'x' as runs", "2 as words", "3 as g").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((brute_row(*r) for r in rows), key=str)
    assert any(r[4] and r[4] > 64 for r in got) and sum(r[1] > 1 for r in got) > 20


def test_real_outputs(spark):
    df = spark.createDataFrame([(1, "a  b a b a b a b c"), (2, "z")], "id long, body string")
    rows = {r.id: r for r in collapse(df, "id", "body").collect()}
    assert [tuple(r) for r in rows[1].runs] == [(0, 8, 2)] and rows[1].collapsed == "a b c"
    assert rows[2].runs == [] and rows[2].n_words == 1
    assert collapse(df.limit(0), "id", "body").count() == 0
    with pytest.raises(ValueError):
        collapse(df, "id", "body", min_exponent=3)
