"""The corpus pipeline: five stages over ``documents``, each one of the
operators of ``tickforge.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last
return the columns of documents, whatever they are; a null or repeated id, a
null text and further columns pass through each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import decontam, langid, line_dedup, minhash_dedup, packing
from tickforge.llm.common import LAST_ID, table, written
from tickforge.llm.queries import tokenizer_path

#: Tokenisation, near-duplicate components and retrieval packing cannot be said in SQL.
ORACLE_SQL = None


def _key():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def _version():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the texts (id, version) of gone; another text under the
    same id, or also without one, stays."""
    texts = gone.select(F.col("id").alias("__id"), F.col("version").alias("__version")).distinct()
    return docs.withColumn("__id", _key()).withColumn("__version", _version()) \
        .join(texts, ["__id", "__version"], "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text has a language; learned from the labelled
    documents of the same table."""
    found = langid.predict(docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns}),
                           langid.fit(docs), text_col="own_text")
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*[F.col(f"own_{c}").alias(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a document of a smaller id has; n_chars
    follows.  Documents of which nothing is left stay, with an empty text."""
    rows = docs.select(_key().alias("__id"), _version().alias("__version"),
                       F.struct(*docs.columns).alias("row"))
    gone = line_dedup.decisions(docs).select(F.col("id").alias("__id"), F.col("version").alias("__version"), "lines")
    kept = line_dedup.without_lines(rows.join(gone, ["__id", "__version"], "left").withColumn(
        "text", F.col("row.text")), "text", "lines")
    changed = {"text": F.when(F.col("lines").isNotNull(), F.col("kept")).otherwise(F.col("row.text")),
               "n_chars": F.when(F.col("lines").isNotNull(), F.length("kept").cast(
                   docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
               if "n_chars" in docs.columns else None}
    return kept.select(*[(changed[c] if c in changed else F.col(f"row.{c}")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return _without(docs, minhash_dedup.decisions(docs).where("id != root"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return _without(docs, decontam.matches(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences."""
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not packed:
            docs = written(docs, f"stage-{name}")
    return docs
