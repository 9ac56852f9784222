"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Training is one aggregation over all labelled rows: tasks count n-grams of
their rows by language and bucket, Spark sums the counts.  The model is a
(languages x buckets) matrix of log probabilities.  Its size is bounded by
``max_languages * 2**bits`` doubles and does not depend on the number of
documents; it is broadcast.  Scoring multiplies the sparse n-gram counts of
each text with the matrix, by gathering and summing its columns in numpy.

Rows with a null text, an empty text or a text without a letter get language
``und`` and score 0.  A null or empty language is not learned.  Without any
labelled row every prediction is ``und``.  Ties go to the first language in
alphabetical order.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickforge.llm.arrowtext import pieces, utf8
from tickforge.llm.common import ship

UNKNOWN = "und"
SIZES = (1, 2, 3)
BITS = 15
MAX_LANGUAGES = 512


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # languages x buckets
    log_prior: np.ndarray
    sizes: tuple[int, ...]
    bits: int


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end (A-Z and Latin-1 capitals as small
    letters), and the offsets of the texts."""
    data, offs = utf8(texts)
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    capital = ((chars >= 65) & (chars <= 90)) | ((chars >= 192) & (chars <= 222) & (chars != 215))
    return chars + 32 * capital.astype(np.uint32), heads[offs]


def grams(chars: np.ndarray, offs: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of one size, and the offsets of each text's."""
    lens = np.diff(offs)
    per = np.maximum(lens - size + 1, 0)
    out = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(out[-1]) + np.repeat(offs[:-1] - out[:-1], per)
    h = np.full(len(at), size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for j in range(size):
        h = (h ^ chars[at + j]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return ((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)).astype(np.int32), out


def _counter(sizes, bits, most):
    """Counts of the rows of a task; what ``most`` languages have is passed on
    before more are counted, so a task holds ``most * 2**bits`` at most."""
    def flushed(totals):
        for lang, (rows, counts) in totals.items():
            used = np.flatnonzero(counts)
            # bucket -1 carries the number of rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(used) + 1), pa.string()),
                 pa.array(np.concatenate([[-1], used]).astype(np.int32)),
                 pa.array(np.concatenate([[rows], counts[used]]).astype(np.int64))],
                names=["lang", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                names, langs = np.unique(piece.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                chars, offs = code_points(piece.column("text"))
                for first in range(0, len(names), most):
                    some = names[first:first + most].tolist()
                    if len(totals.keys() | set(some)) > most:
                        yield from flushed(totals)
                        totals = {}
                    for size in sizes:
                        buckets, at = grams(chars, offs, size, bits)
                        lang_of = np.repeat(langs, np.diff(at))
                        for k, lang in enumerate(some, first):
                            own = totals.setdefault(lang, [0, np.zeros(1 << bits, np.int64)])
                            own[1] += np.bincount(buckets[lang_of == k], minlength=1 << bits)
                    for k, lang in enumerate(some, first):
                        totals[lang][0] += int((langs == k).sum())
        yield from flushed(totals)
    return count


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: tuple[int, ...] = SIZES,
        bits: int = BITS, max_languages: int = MAX_LANGUAGES, smoothing: float = 0.5) -> Model:
    """Learn from all rows with a text and a language.

    More than ``max_languages`` languages raise an error: the model, which is
    gathered on the driver and broadcast, has ``max_languages * 2**bits``
    entries at most.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null and lang != ''")
    counts = rows.mapInArrow(_counter(sizes, bits, max_languages), "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counts.limit(max_languages * ((1 << bits) + 1) + 1).toArrow()
    names = sorted(set(got.column("lang").to_pylist()))
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    table = np.zeros((len(names), 1 << bits))
    priors = np.zeros(len(names))
    index = {x: i for i, x in enumerate(names)}
    row = np.array([index[x] for x in got.column("lang").to_pylist()], np.int64)
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    grams_ = bucket >= 0
    table[row[grams_], bucket[grams_]] = n[grams_]
    priors[row[~grams_]] = n[~grams_]
    prob = (table + smoothing) / (table.sum(1, keepdims=True) + smoothing * (1 << bits))
    return Model(names, np.log(prob), np.log(priors / max(priors.sum(), 1)), tuple(sizes), bits)


def log_likelihood(model: Model, texts: pa.Array) -> np.ndarray:
    """texts x languages."""
    chars, offs = code_points(texts)
    out = np.tile(model.log_prior, (len(texts), 1))
    for size in model.sizes:
        buckets, at = grams(chars, offs, size, model.bits)
        some = np.flatnonzero(np.diff(at))
        if len(some):
            for k in range(len(model.languages)):
                out[some, k] += np.add.reduceat(model.log_prob[k][buckets], at[some])
    return out


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input's columns, and lang_pred, score (the posterior of the
    predicted language)."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = StructType(rows.schema.fields[:-1]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for piece in pieces(batch, "__text"):
                texts = piece.column("__text")
                lang = np.full(len(texts), UNKNOWN, object)
                score = np.zeros(len(texts))
                some = np.array([_has_letter(x) for x in texts.to_pylist()], bool)
                if m.languages and some.any():
                    own = log_likelihood(m, texts.filter(pa.array(some)))
                    best = own.argmax(1)
                    lang[some] = np.array(m.languages, object)[best]
                    score[some] = 1 / np.exp(own - own.max(1, keepdims=True)).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(piece.num_columns - 1)]
                    + [pa.array(lang, pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
