"""Named warehouse sources (the marts' inputs) and table materialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tickforge.sources.ordered import arranged


class Warehouse:
    """Resolves source names to catalog tables or storage paths.

    ``locations`` maps a name (e.g. ``fact_market_candles``) to either a
    catalog table name or a path (anything containing ``/`` or ``:``).
    Unknown names are read as catalog tables.
    """

    def __init__(self, spark: SparkSession, locations: dict[str, str] | None = None,
                 fmt: str = "parquet"):
        self.spark, self.locations, self.fmt = spark, dict(locations or {}), fmt

    @staticmethod
    def _is_path(loc: str) -> bool:
        return "/" in loc or ":" in loc

    def source(self, name: str) -> DataFrame:
        loc = self.locations.get(name, name)
        if self._is_path(loc):
            return self.spark.read.format(self.fmt).load(loc)
        return self.spark.table(loc)

    def materialize(self, name: str, df: DataFrame, partition_by: list[str] | None = None,
                    order_by: list[Column] | None = None) -> str:
        """Full rebuild of ``name`` (overwrite), as a table-materialised model;
        ``order_by``: stored in this order (``sources.ordered``)."""
        loc = self.locations.get(name, name)
        if order_by:
            df = arranged(df, order_by)
        w = df.write.mode("overwrite").format(self.fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if self._is_path(loc):
            w.save(loc)
        else:
            w.saveAsTable(loc)
        return loc
