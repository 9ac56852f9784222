import os
from types import SimpleNamespace

import pytest

from tickforge.session import RUNTIME_CONF, clear_runs, library_session, require_utc, run_dir, shared_dir

KEY = "spark.sql.session.timeZone"


def test_the_callers_session_stays_as_it_is(spark):
    own = spark.newSession()
    own.conf.set(KEY, "Asia/Tokyo")
    own.conf.set("spark.sql.shuffle.partitions", "5")
    with pytest.raises(ValueError):
        require_utc(own)
    lib = library_session(own)
    assert own.conf.get(KEY) == "Asia/Tokyo"
    assert all(lib.conf.get(k) == v for k, v in RUNTIME_CONF.items())
    assert lib.conf.get("spark.sql.shuffle.partitions") == "5"
    require_utc(lib)
    assert library_session(lib) is lib


def test_registered_queries_do_not_change_the_session(spark):
    import __spark_entry__
    own = spark.newSession()
    own.conf.set(KEY, "Asia/Tokyo")
    df = __spark_entry__.queries()["silver_dedup"](own, "/root/testdata/sf0.001")
    assert own.conf.get(KEY) == "Asia/Tokyo" and df.sparkSession.conf.get(KEY) == "UTC"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master=master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_run_folders_are_fresh_and_can_be_cleared(spark):
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b
    spark.range(3).write.parquet(a)
    assert clear_runs(spark) >= 1
    assert not os.path.exists(a.replace("file:", ""))
