import random
import zlib

import numpy as np
import pytest

from brute import corpus
from tickforge.llm import packing
from tickforge.llm.packing import Index, pack, pack_shard

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, rows, window):
    """Exact round trip: the pieces of each document are its ids."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    want = sorted((i is None, i or 0, tuple(t.encode(x or "", add_special_tokens=False).ids) + (1,)) for i, x in docs)
    by_doc, by_sequence = {}, {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        by_doc.setdefault((r.doc_id is None, r.doc_id or 0), []).append((r.start, tuple(ids), r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by_sequence.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))]
        total = sum(n for _, n in s)
        assert 0 < total <= window and total & (total - 1) == 0
    if len({(i is None, i or 0) for i, _ in docs}) == len(docs):
        got = []
        for key, ps in by_doc.items():
            ps.sort()
            whole = tuple(x for _, ids, _ in ps for x in ids)
            assert [a for a, _, _ in ps] == [sum(len(x) for _, x, _ in ps[:k]) for k in range(len(ps))]
            assert {n for *_, n in ps} == {len(whole)}
            got.append((*key, whole))
        assert sorted(got) == want
    assert sum(r.length for r in rows) == sum(len(x) for *_, x in want)


@pytest.mark.parametrize("window,shard", [(2048, 1 << 19), (64, 2000), (16, 100)])
def test_round_trip(spark, window, shard):
    rng = random.Random(window)
    docs = corpus(6) + [(900, None), (901, "it's <|endoftext|> we'll  \n\n x\t y  "), (None, "no id"), (902, "é" * 5000),
                        (903, "".join(rng.choice("ab \n'sé1!") for _ in range(3000)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(docs, pack(df, PATH, window=window, shard_tokens=shard).collect(), window)


def test_odd_tables(spark):
    docs = [(1, "same"), (1, "same"), (None, None), (None, None), (2, "")]
    df = spark.createDataFrame([(*x, 5) for x in docs], "doc_id long, text string, length int")
    check(docs, pack(df, PATH).collect(), 2048)
    assert pack(df.limit(0), PATH).count() == 0


def test_scores_are_bm25():
    docs = [np.array(x, np.uint32) for x in ([5, 5, 7, 9], [5, 8], [9, 9, 9, 7, 2, 3])]
    df = np.zeros(10, np.int64)
    for x in docs:
        df[np.unique(x)] += 1
    index = Index(docs, df, 3, 4.0)
    for seed in range(3):
        want = []
        for x in docs:
            s = 0.0
            for t in set(docs[seed].tolist()):
                tf = int((x == t).sum())
                idf = np.log(1 + (3 - df[t] + 0.5) / (df[t] + 0.5))
                s += idf * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(x) / 4.0))
            want.append(s)
        assert np.allclose(index.scores(seed), want)


def test_neighbours_share_windows():
    """Two vocabularies: windows hold one of them."""
    rng = np.random.default_rng(1)
    docs = [(rng.integers(0, 100, 40) + 500 * (i % 2)).astype(np.uint32) for i in range(64)]
    df = np.bincount(np.concatenate([np.unique(x) for x in docs]), minlength=1000)
    kinds = {}
    for d, _, n, s, _ in pack_shard(docs, np.zeros(64, np.int64), df, 64, 40.0, 160):
        kinds.setdefault(s, set()).add(d % 2)
    assert sum(len(k) == 1 for k in kinds.values()) >= len(kinds) - 2


@pytest.mark.parametrize("groups", [480, 1920])
def test_near_documents_are_dealt_to_one_shard(spark, groups):
    """Each document's brute-force top neighbour is its changed copy.  As many
    share a sequence as in one shard of all documents, at either size; the
    number of shuffle partitions does not matter."""
    rng = random.Random(groups)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    docs = []
    for g in range(groups):
        text = [rng.choice(vocabulary) for _ in range(60)]
        other = list(text)
        other[rng.randrange(60)] = "changed"
        docs += [(g, " ".join(text)), (100_000 - g, " ".join(other))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    before, rows = spark.conf.get("spark.sql.shuffle.partitions"), {}
    for n in ("3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            rows[n] = sorted(pack(df, PATH, window=1024, shard_tokens=1 << 16).drop("ids").collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows["3"] == rows["50"]
    assert len({r.sequence_id >> 32 for r in rows["3"]}) >= groups // 900
    whole = pack(df, PATH, window=1024, shard_tokens=1 << 26).drop("ids").collect()

    def together(found):
        where = {}
        for r in found:
            where.setdefault(r.doc_id, set()).add(r.sequence_id)
        return sum(bool(where[g] & where[100_000 - g]) for g in range(groups))

    assert together(rows["3"]) >= 0.9 * together(whole)
    assert together(whole) >= 0.8 * groups


def test_rest_goes_to_the_next_shard(spark):
    """Only a task's last sequences are shorter than a window, also where a
    third of all rows are the same row."""
    docs = [(i if i % 3 else None, "same text" if i % 3 == 0 else " ".join(f"w{i}x{j}" for j in range(9)))
            for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = pack(df, PATH, window=64, shard_tokens=256).collect()
    check(docs, rows, 64)
    size, parts = {}, {}
    for r in rows:
        size[r.sequence_id] = size.get(r.sequence_id, 0) + r.length
    for s, n in size.items():
        parts.setdefault(s >> 32, []).append(n)
    assert len(parts) > 3 and all(sum(n < 64 for n in p) <= 6 for p in parts.values())
