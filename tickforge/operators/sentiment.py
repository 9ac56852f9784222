"""Market-sentiment dimension: parse landed API documents, latest-wins upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.functions import col_, date_from_epoch_seconds
from tickforge.sources.buckets import BucketTable


def parse_documents(docs: DataFrame, text_col: str = "value", updated_at=None) -> DataFrame:
    """Take ``data[0]`` of each JSON document -> (date, fng_value,
    fng_classification, updated_at).  Documents without a reading or with
    a non-numeric value are dropped."""
    doc = F.from_json(col_(text_col).cast("string"), schemas.SENTIMENT_DOC)
    # one parse per document: the reading becomes an attribute first
    docs = docs.select(F.get(doc.getField("data"), 0).alias("_r"))
    r = F.col("_r")
    if updated_at is None:
        upd = F.current_timestamp()
    elif isinstance(updated_at, Column):
        upd = updated_at
    else:
        upd = F.lit(updated_at).cast("timestamp")
    out = docs.select(
        date_from_epoch_seconds(r.getField("timestamp")).alias("date"),
        r.getField("value").try_cast("int").alias("fng_value"),
        r.getField("value_classification").alias("fng_classification"),
        upd.alias("updated_at"),
    )
    return out.filter(F.col("date").isNotNull() & F.col("fng_value").isNotNull())


def upsert_latest(current: DataFrame, incoming: DataFrame, key: str = "date",
                  order_col: str = "updated_at") -> DataFrame:
    """Keyed upsert: incoming rows replace stored rows with the same key.

    Within the incoming batch the row with the greatest ``order_col`` wins
    (ties: greatest remaining values).  The result is
    ``stored LEFT ANTI JOIN incoming  UNION  latest incoming``: only the
    (usually small) incoming batch is aggregated, and when AQE measures it
    as small the anti join becomes a broadcast join that streams the stored
    table without shuffling it.  ``store_latest`` writes the result back.
    """
    cols = current.columns
    rest = [c for c in cols if c != key]
    rank = F.struct(F.col(order_col), *[F.col(c) for c in rest if c != order_col])
    latest = (incoming.groupBy(key)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_row"))
              .select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]))
    kept = current.join(latest.select(key), key, "left_anti")
    return kept.select(*cols).unionByName(latest.select(*cols))


def stored(spark: SparkSession, path: str) -> BucketTable:
    """The stored dimension: one bucket for each month."""
    return BucketTable(spark, path, schemas.SENTIMENT, F.date_format("date", "yyyy-MM"))


def store_latest(spark: SparkSession, incoming: DataFrame, path: str) -> DataFrame:
    """Upsert ``incoming`` into the stored dimension at ``path`` and return
    it: one row per date.  Only the months of the incoming dates are read and
    written; the load is seen wholly or not at all, and of loads at the same
    time none is lost (``sources.buckets``)."""
    table = stored(spark, path)
    table.merge(incoming, upsert_latest)
    return table.rows()


def one_per_date(rows: DataFrame) -> DataFrame:
    """The newest row of each date (by updated_at)."""
    rest = [c for c in rows.columns if c not in ("date", "updated_at")]
    lead = ["updated_at"] if "updated_at" in rows.columns else []
    last = F.max(F.struct(*lead, *rest)).alias("_r")
    return rows.groupBy("date").agg(last).select(*[F.col(c if c == "date" else f"_r.{c}").alias(c) for c in rows.columns])
