import random

import pyarrow as pa
import pytest

from tickforge.llm.langid import SIZES, UNKNOWN, _counter, fit, predict

SYLLABLES = {"aa": "the th er on an re in ou".split(), "bb": "die der ü ich ein ver ß".split(), "cc": "le é que è ai oi".split()}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, lang), lang) for i, lang in enumerate(sorted(SYLLABLES) * 60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(table):
    model = fit(table.where("doc_id % 3 != 1 or doc_id > 170"))
    got = predict(table.where("doc_id % 3 = 1").select("doc_id", "text", "lang"), model).collect()
    assert len(got) >= 55 and all(r.lang == r.lang_pred and 0.9 < r.score <= 1 for r in got)


def test_same_as_plain_counts(spark):
    """Two texts, one-letter grams: the textbook formula."""
    import math
    from collections import Counter
    df = spark.createDataFrame([("aab", "x"), ("bbbc", "y"), ("c", "y")], "text string, lang string")
    model = fit(df, sizes=(1,), smoothing=0.5)
    counts = {"x": Counter("aab"), "y": Counter("bbbcc")}

    def p(lang, t):
        n = sum(counts[lang].values())
        return math.log({"x": 1 / 3, "y": 2 / 3}[lang]) + sum(
            math.log((counts[lang][c] + 0.5) / (n + 0.5 * 2**15)) for c in t)

    for t in ("ab", "ccb", "a"):
        r = predict(spark.createDataFrame([(t,)], "text string"), model).first()
        best = max("xy", key=lambda x: p(x, t))
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(math.exp(p(x, t) - p(best, t)) for x in "xy"))


def test_odd_rows(spark, table):
    model = fit(table)
    rows = [(None, "x"), ("", "y"), ("12 34 !?", "z"), ("the the ther" * 9000, "w"), ("É", None), ("\U0001d400 the er", "v")]
    got = predict(spark.createDataFrame(rows, "text string, lang_pred string"), model).collect()
    assert [r.lang_pred for r in got][:4] == [UNKNOWN] * 3 + ["aa"] and [r.score for r in got][:3] == [0.0] * 3
    assert got[4].lang_pred == "cc" and got[5].lang_pred == "aa"
    assert predict(table.limit(0), model).count() == 0
    none = fit(table.limit(0))
    assert {r.lang_pred for r in predict(table, none).collect()} == {UNKNOWN}
    nulls = fit(spark.createDataFrame([("a", None), (None, "x"), ("b", ""), ("the er", "q")], "text string, lang string"))
    assert nulls.languages == ["q"]


def test_too_many_languages(spark, table):
    with pytest.raises(ValueError):
        fit(table, max_languages=2)


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_a_dirty_language_column_is_counted_piece_by_piece(most):
    """A task holds ``most`` languages' counts; parts add up to the whole."""
    from collections import Counter
    rows = [(f"text {k % 13}", f"l{k * k % 40}") for k in range(300)]
    batches = [pa.RecordBatch.from_pylist([{"text": t, "lang": x} for t, x in rows[a:a + 70]]) for a in range(0, 300, 70)]

    def total(limit):
        out = Counter()
        for part in _counter(SIZES, 8, limit)(iter(batches)):
            for r in part.to_pylist():
                out[r["lang"], r["bucket"]] += r["n"]
        return out

    got = total(most)
    assert got == total(10**6) and sum(n for (_, b), n in got.items() if b < 0) == 300
