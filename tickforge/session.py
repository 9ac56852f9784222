"""Session helpers.

The library never owns the session: every function takes a
``SparkSession`` (or a DataFrame) from the caller. ``build_session`` is a
convenience for tests, the bench and command-line runs.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every query of the library relies on.  UTC is
# pinned because event time is stored as epoch milliseconds and
# partitioned by calendar day/hour.  Broadcast joins are chosen only from
# sizes measured at run time: the static, estimate-based choice is off,
# and AQE turns a shuffle join into a broadcast join after the small
# side's shuffle stage has run and reported its actual size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}

# Session settings: the runtime ones plus AQE, which coalesces small
# shuffles and splits skewed join partitions.  Shuffle partitions are
# merged up to 128 MB each (while a shuffle is small, Spark's
# parallelism-first default still keeps about one per core), so
# ``spark.sql.shuffle.partitions`` can be set for the largest input (the
# reducers a 100 TB run needs) without costing small runs.
CORE_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Large streaming state lives off-heap in RocksDB, not in the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "tickforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's core settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("the session's time zone must be UTC; see library_session")


def library_session(spark: SparkSession, new: bool = False) -> SparkSession:
    """``spark`` itself if it has ``RUNTIME_CONF``, else (or with ``new``) a
    session of its own on the same context with the caller's settings and
    ``RUNTIME_CONF``.  The caller's session is never changed."""
    if not new and all(spark.conf.get(k, None) == v for k, v in RUNTIME_CONF.items()):
        return spark
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in RUNTIME_CONF.items():
        own.conf.set(k, v)
    return own


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch area.

    Taken from ``spark.checkpoint.dir`` as configured for the cluster.  Where
    it is unset, a local master (tests) gets a private temporary folder,
    removed when Python ends; on a cluster that is an error, as each executor
    would write to its own disk.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tickforge-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_runs: list[str] = []


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder name under the shared scratch area.  It
    holds what a returned DataFrame reads, so the library cannot remove it;
    ``clear_runs`` does when the caller is done."""
    path = f"{shared_dir(spark)}/tickforge/{label}-{uuid.uuid4().hex[:12]}"
    _runs.append(path)
    return path


def clear_runs(spark: SparkSession) -> int:
    """Delete the run folders this process has made; returns their number."""
    n = 0
    while _runs:
        path = spark._jvm.org.apache.hadoop.fs.Path(_runs.pop())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        n += bool(fs.exists(path) and fs.delete(path, True))
    return n


def object_store_conf(endpoint: str | None, access_key: str | None = None,
                      secret_key: str | None = None, path_style: bool = True,
                      ssl: bool = False) -> dict:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    Returns no settings when ``endpoint`` is empty, so the default AWS
    endpoint and credential chain apply.  Pass the result as ``extra`` to
    ``build_session`` (the settings must be present before the first
    filesystem access).  Lake paths then use ``s3a://bucket/...``.
    """
    if not endpoint:
        return {}
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if access_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf
