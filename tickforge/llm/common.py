"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tickforge
from tickforge.session import run_dir

#: Stands for a null id in joins and orders: it comes after every other id.
LAST_ID = (1 << 63) - 1


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for a context, so
    that Python workers can import it wherever they run.  Nothing to do where
    it already came as an archive (``--py-files``)."""
    sc = spark.sparkContext
    root = Path(tickforge.__file__).parent
    if getattr(sc, "_tickforge_shipped", False) or not root.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="tickforge-src-")) / "tickforge.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._tickforge_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): ids as long with null as LAST_ID, null text as empty."""
    ship(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def public_id(col: str = "id"):
    """The id column as callers see it: LAST_ID is null again."""
    return F.when(F.col(col) != F.lit(LAST_ID), F.col(col))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh folder of the shared scratch area and read back: cuts
    the lineage, so a lost executor costs at most the stage that runs."""
    spark = df.sparkSession
    path = f"{run_dir(spark, label)}/{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing will read again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, root) of all nodes (id, distinct): root is the smallest id that
    the edges (a, b) reach.  Each node begins with the smallest id around it;
    each round it takes the smallest label around it, and then its label's
    label, which halves long chains; it stops when no label changes.  Labels
    are written each round."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .where("a != b").distinct(), "edges")
    if both.isEmpty():
        return nodes.select("id", F.col("id").alias("root"))
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "root"), "b") \
            .groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        step = labels.join(near, "id").select("id", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        # a label is the id of a node, with a label of its own
        up = labels.select(F.col("id").alias("root"), F.col("root").alias("up"))
        moved = written(step.join(up, "root").select("id", F.least("up", "root").alias("root"), "old"), "labels")
        labels = moved.select("id", "root")
        if moved.where("root != old").isEmpty():
            break
    return nodes.join(labels, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
