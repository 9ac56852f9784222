import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators.sentiment import store_latest, stored, upsert_latest
from tickforge.sources.files import names, put_if_absent, read

T0 = dt.datetime(2024, 6, 1)


def rows(spark, *dates, value=1, at=T0):
    return spark.createDataFrame([(d and dt.date.fromisoformat(d), value, "x", at) for d in dates], schemas.SENTIMENT)


def values(spark, path):
    return {str(r.date): r.fng_value for r in stored(spark, path).rows().collect()}


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(f"{path}/data") for f in names if f.startswith("part-")}


def test_a_load_changes_its_own_buckets_only(spark, fresh_dir):
    assert values(spark, fresh_dir) == {}
    store_latest(spark, rows(spark, "2024-01-01", "2024-01-02", "2024-02-01", None), fresh_dir)
    before = files(fresh_dir)
    store_latest(spark, rows(spark, "2024-02-01", "2024-02-02", value=5, at=T0.replace(day=2)), fresh_dir)
    assert values(spark, fresh_dir) == {"2024-01-01": 1, "2024-01-02": 1, "2024-02-01": 5, "2024-02-02": 5, "None": 1}
    held = stored(spark, fresh_dir).commit().buckets
    assert set(held) == {"2024-01", "2024-02", "none"}
    now = files(fresh_dir)
    assert all(now[f] == t for f, t in before.items() if "2024-02" not in f)
    scan = stored(spark, fresh_dir).rows(buckets=["2024-02"])
    assert len(scan.inputFiles()) < len(stored(spark, fresh_dir).rows().inputFiles()) and scan.count() == 2


def test_old_data_goes_after_two_commits(spark, fresh_dir):
    for n in range(5):
        store_latest(spark, rows(spark, "2024-01-01", value=n, at=T0.replace(day=n + 1)), fresh_dir)
    assert values(spark, fresh_dir) == {"2024-01-01": 4}
    assert len([f for f in files(fresh_dir)]) == 2      # of the newest commit and the one before
    table = stored(spark, fresh_dir)
    assert table.rows(table.commit(4)).first().fng_value == 3


def test_a_failed_load_leaves_the_table(spark, fresh_dir):
    store_latest(spark, rows(spark, "2024-01-01"), fresh_dir)
    before = files(fresh_dir)
    bad = rows(spark, "2024-01-02").withColumn("fng_value", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        store_latest(spark, bad, fresh_dir)
    with pytest.raises(ValueError, match="merge"):
        stored(spark, fresh_dir).merge(rows(spark, "2024-01-02"), lambda a, b: (_ for _ in ()).throw(ValueError("merge")))
    assert values(spark, fresh_dir) == {"2024-01-01": 1} and stored(spark, fresh_dir).commit().number == 1
    assert files(fresh_dir) == before


@pytest.mark.parametrize("other,merges", [("2024-01-09", 2), ("2024-03-09", 1)])
def test_a_writer_that_was_overtaken_loses_nothing(spark, fresh_dir, other, merges):
    """Another load is committed while this one merges: the same month is
    merged again, another month is not."""
    store_latest(spark, rows(spark, "2024-01-01", "2024-02-01"), fresh_dir)
    calls = []

    def slow(old, new):
        calls.append(1)
        if len(calls) == 1:
            store_latest(spark, rows(spark, other, value=7), fresh_dir)
        return upsert_latest(old, new)

    assert stored(spark, fresh_dir).merge(rows(spark, "2024-01-02", value=3), slow) == 3
    assert len(calls) == merges
    assert values(spark, fresh_dir) == {"2024-01-01": 1, "2024-02-01": 1, other: 7, "2024-01-02": 3}


def test_writers_at_the_same_time(spark, fresh_dir):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda d: store_latest(spark, rows(spark, f"2024-01-{d:02d}", value=d), fresh_dir), range(1, 9)))
    assert values(spark, fresh_dir) == {f"2024-01-{d:02d}": d for d in range(1, 9)}
    assert stored(spark, fresh_dir).commit().number == 8


def test_a_file_is_put_once(spark, fresh_dir):
    path = f"{fresh_dir}/deep/name.json"
    assert put_if_absent(spark, path, "a\nb") and not put_if_absent(spark, path, "c")
    assert read(spark, path) == "a\nb" and names(spark, f"{fresh_dir}/deep") == ["name.json"]
    assert names(spark, f"{fresh_dir}/none") == []


def test_a_replayed_batch_is_left_out(spark, fresh_dir):
    table = stored(spark, fresh_dir)

    def add(old, new):
        return old.unionByName(new)

    assert table.merge(rows(spark, "2024-01-01"), add, ("s", 0)) == 1
    assert table.merge(rows(spark, "2024-01-01"), add, ("s", 0)) == 1
    assert table.merge(rows(spark, "2024-01-01"), add, ("other", 0)) == 2
    assert table.merge(rows(spark, "2024-01-02"), add, ("s", 1)) == 3
    assert table.rows().count() == 3 and table.commit().applied == {"s": 1, "other": 0}
    assert table.merge(rows(spark).limit(0), add, ("s", 2)) == 3
