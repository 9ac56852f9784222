import numpy as np
import pyarrow as pa
import pytest

from brute import corpus, near_components, shingles
from tickforge.llm import minhash_dedup
from tickforge.llm.arrowtext import text_shingles
from tickforge.llm.minhash_dedup import near_duplicates, signatures


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("seed,pct,small", [(1, 85, 32), (2, 85, 2), (3, 80, 4), (4, 60, 2)])
def test_equals_all_pairs(spark, seed, pct, small):
    """Also with nearly every bucket sent past its pivot through the index of rare differences."""
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i: (n, c, i == c) for i, (n, c) in near_components(docs, pct).items()}
    # rows=2: so many candidates that no link is missed at 60 %
    assert got(near_duplicates(df, pct=pct, small=small, rows=2 if pct < 80 else 4)) == want


def test_shingle_counts_match_plain_python():
    texts = [t for _, t in corpus(5)]
    h, offs, _ = text_shingles(pa.array(texts))
    assert [len(np.unique(h[a:b])) for a, b in zip(offs, offs[1:])] == [len(shingles(t)) for t in texts]


def test_coordinates_agree_as_often_as_sets(spark):
    a, b = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    from tickforge.llm.arrowtext import mix
    flat = np.concatenate([mix(a + np.uint64(7)), mix(b + np.uint64(7))])
    sig = signatures(flat, np.array([0, 900, 1800]), 1000)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.06


def test_odd_rows(spark):
    text = "a b c d e f g h"
    rows = [(1, None, "x"), (2, text, None), (None, text, "y"), (2, text, "z"), (5, "", "z"), (None, "k l m n o p", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert out == sorted([(1, 0, 1, True), (2, 4, 2, True), (None, 4, 2, False), (2, 4, 2, True), (5, 0, 5, True),
                          (None, 2, None, True)], key=str)
    assert near_duplicates(df.limit(0)).count() == 0


def test_buckets_are_never_expanded(spark):
    """A group of copies of many sizes makes few pairs."""
    rows = [(i, "same words in every one of these texts " + ("tail" if i % 2 else "end")) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(df, pct=50).collect()} == {0}
    assert minhash_dedup.SMALL < 600
