import hashlib

import numpy as np
import pyarrow as pa
import pytest

from brute import corpus, shingles
from tickforge.llm import fingerprints
from tickforge.llm.fingerprints import (
    compare_with_next, containment, decode, distinct, fingerprint, merge, merged, resemblance, sketches,
)


def brute(docs):
    rows = sorted(((1 << 63) - 1 if i is None else i, (t or "")) for i, t in docs)
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + following[:cut]
        out.append((None if i == (1 << 63) - 1 else i, len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited, following))
    return out


def exact(a, b):
    p, q = shingles(a), shingles(b)
    return len(p & q) / len(p | q) if p | q else 1.0


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_python(spark, seed):
    docs = corpus(seed)
    docs = [(7 * i + (seed if i % 3 else 0), t) for i, t in docs] + [(None, "no id"), (5000, None)]
    got = sorted(compare_with_next(spark.createDataFrame(docs, "doc_id long, text string")).collect(),
                 key=lambda r: (r.doc_id is None, r.doc_id))
    want = brute(docs)
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [w[:3] for w in want]
    for r, (*_, text, edited, following) in zip(got, want):
        for value, other in ((r.near_edited, edited), (r.near_next, following)):
            few = len(shingles(text) | shingles(other)) <= fingerprints.K  # then the sketches are the sets
            assert value == pytest.approx(exact(text, other), abs=1e-9 if few else 0.1)
    by_text = {}
    for r, w in zip(got, want):
        assert by_text.setdefault(w[3], r.fingerprint) == r.fingerprint


def test_long_texts_are_estimated(spark):
    words = [f"w{i}" for i in range(4000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[1000:])), (3, " ".join(words[:3500]))]
    rows = {r.doc_id: r for r in compare_with_next(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert abs(rows[1].near_next - 0.75) < 0.12 and len(rows[1].fingerprint) == 16 * fingerprints.K
    a, b = sketches(pa.array([d[1] for d in docs[:2]]))
    assert abs(distinct(a) - 3996) < 1000 and abs(containment(b, a) - 1) < 0.15
    assert np.array_equal(merge(a, b), a) and resemblance(a, a) == 1.0


def test_parts_merge_into_the_whole(spark):
    words = [f"w{i}" for i in range(900)]
    docs = [(k, " ".join(words[a:b]), "x") for k, (a, b) in enumerate([(0, 400), (300, 700), (600, 900)])] + [(9, "", "x")]
    prints = fingerprint(spark.createDataFrame(docs, "doc_id long, text string, part string"))
    whole = merged(prints.withColumn("part", prints.doc_id * 0), ["part"]).collect()
    want = sketches(pa.array([" ".join(words)]))[0]
    assert np.array_equal(decode(whole[0].fingerprint), want)


def test_odd_tables(spark):
    df = spark.createDataFrame([(3, "a b", 1), (3, "a b", 2), (None, None, 3), (None, "zz", 4)], "doc_id long, text string, part int")
    got = sorted((r.doc_id is None, r.n_chars, r.edited_sha256) for r in compare_with_next(df).collect())
    want = sorted((w[0] is None, *w[1:3]) for w in brute([(3, "a b"), (3, "a b"), (None, ""), (None, "zz")]))
    assert got == want
    one = compare_with_next(df.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert compare_with_next(df.limit(0)).count() == 0


def test_many_ids_in_one_range(spark):
    """More partitions than ids and far more ids than ranges."""
    for n in (2, 3000):
        df = spark.range(n).selectExpr("id * 1000003 % 7919 as doc_id", "concat('t', id) as text")
        rows = compare_with_next(df).collect()
        assert len(rows) == n
        docs = [(r.doc_id, r.text) for r in df.collect()]
        assert {(r.doc_id, r.edited_sha256) for r in rows} == {(w[0], w[2]) for w in brute(docs)}


def test_the_plan_does_not_grow_with_the_partitions(spark):
    """Ranges are one constant; an id finds its own by halving."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "500")
    own.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    df = own.range(9000).selectExpr("id * 7 as doc_id", "concat('word ', id % 97) as text")
    out = compare_with_next(df)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("cast(") < 60 and plan.count("lambdafunction") < 10
    rows = {r.doc_id: r.edited_sha256 for r in out.collect()}
    assert rows == {i: sha for i, _, sha, *_ in brute([(k * 7, f"word {k % 97}") for k in range(9000)])}
