import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tickforge.operators import marts
from tickforge.sources.ordered import with_position, write_ordered


def files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_files_in_name_order_are_in_order_and_do_not_overlap(spark, fresh_dir):
    rows = spark.range(20_000).selectExpr(
        "timestamp_seconds(3600 * (id * 7919 % 5000)) as ingestion_hour", "concat('S', id % 4) as symbol", "id")
    rows = rows.unionByName(spark.sql("select cast(null as timestamp) ingestion_hour, 'S0' symbol, 1L id"))
    write_ordered(rows, fresh_dir, marts.health_order(), parts=8)
    names = files(fresh_dir)
    assert len(names) == 8
    stored = [r for f in names for r in pq.read_table(f"{fresh_dir}/{f}").select(["ingestion_hour", "symbol"]).to_pylist()]
    want = [r.asDict() for r in rows.select("ingestion_hour", "symbol").orderBy(*marts.health_order()).collect()]
    assert [(r["ingestion_hour"] and r["ingestion_hour"].replace(tzinfo=None), r["symbol"]) for r in stored] == [
        (r["ingestion_hour"], r["symbol"]) for r in want]
    # row groups of later files end where those before begin
    stats = []
    for f in names:
        meta = pq.read_metadata(f"{fresh_dir}/{f}")
        column = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index("ingestion_hour")
        groups = [meta.row_group(g).column(column) for g in range(meta.num_row_groups)]
        if all(g.is_stats_set and g.statistics.has_min_max for g in groups):
            stats.append((min(g.statistics.min for g in groups), max(g.statistics.max for g in groups)))
        else:  # INT96 times have none: the values themselves
            values = [v for v in pq.read_table(f"{fresh_dir}/{f}").column("ingestion_hour").to_pylist() if v is not None]
            stats.append((min(values), max(values)))
    assert all(later[1] <= earlier[0] for earlier, later in zip(stats, stats[1:]))


def test_position_of_stored_rows(spark, fresh_dir):
    rows = spark.range(5000).selectExpr("date_add(date'2024-01-01', cast(id % 900 as int)) as date", "cast(id as string) as symbol")
    write_ordered(rows, fresh_dir, marts.prices_order(), parts=5)
    got = with_position(spark, fresh_dir)
    assert got.columns == ["date", "symbol", "position"]
    ranked = [(r.date, r.symbol) for r in got.orderBy("position").collect()]
    assert ranked == [(r.date, r.symbol) for r in rows.orderBy(*marts.prices_order()).collect()]
    assert got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first() == (1, 5000, 5000)


def test_small_tables_are_one_file_and_empty_ones_are_read(spark, fresh_dir):
    rows = spark.range(10).selectExpr("date'2024-01-01' as date", "cast(id as string) as symbol")
    write_ordered(rows, f"{fresh_dir}/few", marts.prices_order(), parts=1)
    assert len(files(f"{fresh_dir}/few")) == 1
    write_ordered(rows.limit(0), f"{fresh_dir}/none", marts.prices_order())
    assert with_position(spark, f"{fresh_dir}/none").count() == 0
