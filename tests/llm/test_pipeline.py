import random

import corpus_pipeline
from brute import near_components, shingles, words
from tickforge.llm.packing import Tokenizer
from tickforge.llm.queries import tokenizer_path


def brute(docs, items):
    """{doc_id: text} before packing."""
    docs = [(i, t) for i, t in docs if t and any(map(str.isalpha, t))]
    owner = {}

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    for i, t in sorted(docs):
        for x in t.split("\n"):
            owner.setdefault(key(x), i)
    docs = [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == i)) for i, t in docs]
    near = near_components(docs, 80)
    docs = [(i, t) for i, t in docs if near[i][1] == i]
    tests = [q for q in map(shingles, items) if q]
    return {i: t for i, t in docs if not any(len(q & shingles(t)) >= 0.8 * len(q) for q in tests)}


def make(tmp, spark):
    rng = random.Random(12)
    items = [" ".join(words(rng, n)) for n in (8, 20, 45)]
    common = "this very line stands in many documents"
    docs = []
    for i in range(120):
        t = words(rng, rng.randrange(1, 150))
        kind = i % 12
        if kind == 1:
            t = t + ["\n"] + common.split() + ["\n"] + words(rng, 5)
        if kind == 2:
            t[len(t) // 2:len(t) // 2] = items[i % 3].split()
        if kind == 3:
            t = docs[-2][1].split(" ") + ["more"]
        docs.append((i, " ".join(t)))
    docs += [(200, None), (201, ""), (202, "123 456"), (203, docs[5][1]), (204, common)]
    spark.createDataFrame([(i, t, "en" if i % 5 else None, "s", len(t or ""), i) for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars int, kept int") \
        .write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id int, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return docs, items


def test_stages_and_run(spark, tmp_path):
    docs, items = make(tmp_path, spark)
    want = brute(docs, items)
    sf = str(tmp_path)
    now = spark.read.parquet(f"{sf}/documents.parquet")
    schema = now.schema
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.schema.names == schema.names and [x.dataType for x in now.schema] == [x.dataType for x in schema], name
    rows = now.collect()
    assert {r.doc_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) and r.kept == r.doc_id for r in rows)
    tok = Tokenizer(tokenizer_path())
    got = {}
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(tok.encode(t)) + 1 for i, t in want.items()}


def test_empty_tables(spark, tmp_path):
    make(tmp_path / "a", spark)
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{tmp_path}/a/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/b/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_null_and_repeated_ids_drop_single_texts(spark, tmp_path):
    """Of several texts under one id, or without one, only the bad go."""
    rng = random.Random(3)
    own = {k: words(rng, 60) for k in (3, 9, 20, 21, 22, 23)}
    item = words(rng, 20)

    def near(k):
        return " ".join(own[k] + ["more"])

    clean = [(3, " ".join(own[3])), (9, " ".join(own[9])), (None, " ".join(own[20])), (12, " ".join(own[21]))]
    copies = [(None, near(3)), (None, near(9)), (12, near(3)), (12, near(9))]
    leaks = [(None, " ".join(own[22] + item)), (12, " ".join(own[23] + item))]
    spark.createDataFrame([(1, " ".join(item))], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(clean + copies + leaks, "doc_id long, text string")

    def rows(df):
        return sorted((str(r.doc_id), r.text) for r in df.collect())

    def as_rows(*parts):
        return sorted((str(i), t) for part in parts for i, t in part)

    once = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert rows(once) == as_rows(clean, leaks)
    assert rows(corpus_pipeline.decontamination(spark, docs, str(tmp_path))) == as_rows(clean, copies)
