import random

import pytest

from brute import sha
from tickforge.llm.line_dedup import LineRuns, dedup_lines, line_keys

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, least=10):
    rows = [((1 << 63) - 1 if i is None else i, t or "") for i, t in docs]
    key = lambda x: x.strip(BLANKS).translate(LOWER)
    owner = {}
    for i, t in rows:
        for x in t.split("\n"):
            owner[key(x)] = min(owner.get(key(x), i), i)
    out = []
    for i, t in rows:
        own = t.split("\n")
        kept = [x for x in own if len(key(x)) < least or owner[key(x)] == i]
        out.append((str(None if i == (1 << 63) - 1 else i), len(own), len(own) - len(kept), sha("\n".join(kept))))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def texts(seed):
    rng = random.Random(seed)
    lines = [f"line number {k} of the corpus" for k in range(25)] + ["short", "", "  ", "ÀÉ ten chars", "ééééééééé", "éééééééééé"]
    odd = [lambda x: x, str.upper, lambda x: f" \t{x}\r", lambda x: x + "\x0b", lambda x: x + "\u00a0"]
    return [(i, "\n".join(rng.choice(odd)(rng.choice(lines)) for _ in range(rng.randrange(0, 9)))) for i in range(120)]


@pytest.mark.parametrize("seed,batches,fan_out", [(1, 4, 2), (2, 1, 2), (3, 7, 3)])
def test_equals_plain_python(spark, seed, batches, fan_out):
    docs = texts(seed)
    random.Random(seed).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(dedup_lines(df, batches=batches, fan_out=fan_out)) == brute(docs)


def test_runs_are_compacted_by_levels(spark):
    runs = LineRuns(spark, 2)
    for b in range(5):
        text = "\n".join(f"line {k} of batch {b % 4} in full" for k in range(20)) + "\na line of every batch"
        keys = line_keys(spark.createDataFrame([(b, text)], "id long, text string"), 10)
        runs.add(keys)
    # 5 batches: one run of level 2 (four batches) and one of level 0
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    stored = runs.all().collect()
    assert len(stored) == 81 and len({(r.h1, r.h2) for r in stored}) == 81
    names = [x for level in runs.levels for x in level]
    runs.close()
    assert not any(spark.catalog.tableExists(x) for x in names)


def test_odd_rows(spark):
    line = "the same long line"
    docs = [(2, f"{line}\nx"), (2, f"x\n{line}"), (2, f"x\n{line}"), (None, line), (None, None), (1, ""), (7, line * 1000 + "\n" + line)]
    df = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, lines string")
    assert rows(dedup_lines(df)) == brute(docs)
    assert dedup_lines(df.limit(0)).count() == 0
