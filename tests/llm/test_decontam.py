import random

import numpy as np

from brute import shingles, words
from tickforge.llm.decontam import contaminated, size_classes, spans


def brute(docs, items, t=0.8):
    out = set()
    for d, text in docs:
        own = shingles(text)
        for k, item in items:
            q = shingles(item)
            if q and len(q & own) >= t * len(q):
                out.add((d, k, len(q & own), len(q)))
    return out


def test_equals_all_pairs(spark):
    rng = random.Random(3)
    items = [(k, " ".join(words(rng, rng.choice([1, 3, 5, 6, 9, 20, 45, 200])))) for k in range(60)]
    docs = []
    for d in range(150):
        text = words(rng, rng.choice([0, 3, 50, 800]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            q = items[rng.randrange(60)][1].split()
            for _ in range(rng.choice([0, 0, 1])):
                q[rng.randrange(len(q))] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = q
        docs.append((d, "  ".join(text).upper() if d % 2 else "\n".join(text)))
    docs += [(200, items[0][1]), (201, None), (202, "")]
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id int, text string"))
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got.collect()} == brute(docs, items)


def test_odd_tables(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, 0), (1, text, 1), (None, text, 2), (4, None, 3), (5, "x " * 9000 + text, 4)],
                                 "doc_id long, text string, item_id int")
    items = spark.createDataFrame([("a", text), ("b", text), ("c", None), ("d", "")], "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert got == {(d, k) for d in (1, None, 5) for k in "ab"}
    assert contaminated(docs, items).count() == 6
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0


def test_size_classes():
    c = size_classes(300)
    assert c[0] == 1 and c[-1] >= 300 and all(b <= max(a + 1, 1.25 * a) for a, b in zip(c, c[1:]))


def test_spans_equal_a_plain_search():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 60, 300).astype(np.uint64)
    at = np.sort(rng.choice(300, 90, False))
    for top in (1, 7, 40):
        want = []
        for i in at:
            a = b = int(i)
            while i - a < top and a > 0 and values[a - 1] >= values[i]:
                a -= 1
            while b - i < top and b + 1 < 300 and values[b + 1] >= values[i]:
                b += 1
            want.append(b - a + 1)
        free = values[at] > 0  # a 0 ends every window
        for cells in (1, 100, 1 << 20):
            got = spans(values, at, top, cells)
            assert got[free].tolist() == np.array(want)[free].tolist()


def test_long_items_in_long_documents(spark):
    """Items as long as documents: places are looked at a bounded number at a time."""
    rng = random.Random(8)
    item = words(rng, 6000)
    changed = [w if k % 400 else "other" for k, w in enumerate(item)]
    docs = [(1, " ".join(words(rng, 3000) + changed)), (2, " ".join(item[:3000])), (3, " ".join(words(rng, 9000)))]
    items = [(7, " ".join(item)), (8, " ".join(item[100:130]))]
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string"))
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got.collect()} == brute(docs, items)
