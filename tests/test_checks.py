import json

import pytest

from tests.helpers import candle_rows
from tickforge.operators import checks
from tickforge.operators.checks import (
    DataTestsFailed, Checked, accepted, fresh, holds, in_range, not_null, references, run_checks, unique, violations)
from tickforge.plans import contracts, medallion


def run(spark, path, **tables):
    got = run_checks(spark, tables, path)
    return {(r.table_name, r.check_name): (r.n_rows, r.n_violations) for r in got.collect()}


def test_each_kind_of_constraint(spark, fresh_dir):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "c", None), (2, None, 200), (3, "z", 7)], "id int, kind string, n int")
    parent = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    got = run(spark, f"{fresh_dir}/v", t=Checked(rows, ("id", "kind"), [
        *not_null("id", "kind"), in_range("n", 0, 100), accepted("kind", "a", "b", "c"), holds("small", "n < 100 or id = 2"),
        unique("id"), unique("id", "kind"), references(["kind"], parent, ["name"], "parent")]))
    assert got == {("t", "not_null_id"): (5, 1), ("t", "not_null_kind"): (5, 1), ("t", "in_range_n"): (5, 2),
                   ("t", "accepted_kind"): (5, 1), ("t", "small"): (5, 0), ("t", "unique_id"): (5, 2),
                   ("t", "unique_id_kind"): (5, 0), ("t", "references_parent"): (5, 1)}
    stored = {(r.check_name, r.key): r for r in violations(spark, f"{fresh_dir}/v").collect()}
    assert set(stored) == {("not_null_id", "NULL|c"), ("not_null_kind", "2|NULL"), ("in_range_n", "1|b"), ("in_range_n", "2|NULL"),
                           ("accepted_kind", "3|z"), ("unique_id", "1"), ("references_parent", "z")}
    assert json.loads(stored["in_range_n", "1|b"].row) == {"id": 1, "kind": "b", "n": -1}
    assert stored["unique_id", "1"].n_rows == 2


def test_freshness_and_empty_tables(spark, fresh_dir):
    rows = candle_rows(spark, [("2024-01-01 00:00:00", "A", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1)])

    def table(df, as_of):
        return Checked(df, ("symbol",), [fresh("candle_start_time", "2 hours", as_of), unique("symbol")])

    for k, (df, clock, bad) in enumerate([(rows, "2024-01-01 01:59:00", 0), (rows, "2024-01-01 02:01:00", 1), (rows.limit(0), "2024-01-01 00:00:00", 1)]):
        assert run(spark, f"{fresh_dir}/{k}", t=table(df, clock))["t", "fresh_candle_start_time"][1] == bad
    assert run(spark, f"{fresh_dir}/empty", t=contracts.candle_checks(rows.limit(0))) == {
        ("t", c.name): (0, 0) for c in contracts.candle_checks(rows).checks}


def test_row_constraints_are_one_pass_and_keys_one_shuffle(spark):
    """A hot key is combined before the shuffle; all constraints share it."""
    from tests.helpers import shuffle_records_written
    rows = spark.range(40_000, numPartitions=4).selectExpr("if(id % 3 = 0, 0, id) as id", "id % 2 as side")
    tables = {"t": Checked(rows, ("id",), [unique("id"), unique("id", "side"), references(["side"], rows, ["side"], "side")])}
    written = shuffle_records_written(checks.key_violations(tables))
    assert len(written) == 1 and written[0] < 2 * 26_667 + 2 * 4 + 100


def test_a_violation_fails_the_run_and_is_stored(spark, fresh_dir):
    lake = medallion.LakePaths(fresh_dir)
    good = candle_rows(spark, [(f"2024-01-01 00:{m:02d}:00", s, 1.0, 2.0, 0.5, 1.5, 4.0, 2.0, 2.0, 3)
                               for m in range(20) for s in ("BTCUSDT", "ETHUSDT")])
    clock = "2024-01-01 01:00:00"
    medallion.write_candles(spark, good, lake)
    medallion.build_marts(spark, lake, clock)
    assert medallion.run_tests(spark, lake, clock).where("not passed").count() == 0
    with pytest.raises(DataTestsFailed, match="fresh_last_updated"):
        medallion.run_tests(spark, lake, "2024-01-03 00:00:00")
    bad = candle_rows(spark, [("2024-01-01 00:30:00", "BTCUSDT", 9.0, 2.0, 0.5, 1.5, 4.0, 2.0, 2.0, 3)] * 2)
    medallion.write_candles(spark, good.unionByName(bad), lake)
    medallion.build_marts(spark, lake, clock)
    with pytest.raises(DataTestsFailed) as failed:
        medallion.run_tests(spark, lake, clock)
    found = {(t, c): n for t, c, n in failed.value.failed}
    assert found["fact_market_candles", "open_within"] == 2 and found["fact_market_candles", "unique_symbol_candle_start_time"] == 2
    path = str(failed.value).rsplit("rows in ", 1)[1]
    keys = {(r.check_name, r.key) for r in violations(spark, path).collect()}
    assert ("unique_symbol_candle_start_time", "BTCUSDT|2024-01-01 00:30:00") in keys
    assert medallion.run_tests(spark, lake, clock, fail=False).where("not passed").count() == len(found)
