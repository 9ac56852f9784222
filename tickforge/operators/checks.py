"""Data tests of stored tables.

All row constraints of a table (not null, range, accepted values, any
condition) are decided in one pass: the counts come from ``observe`` on the
same pass that stores the bad rows.  All key constraints of all tables (unique,
reference) are one grouped pass: keys are tagged with their constraint and
side and counted, combined on the map side, so a key that a third of all rows
hold costs one row for each task.  Neither a table nor its keys reach the
driver, only one count for each constraint.

As with SQL constraints, a NULL passes everything but ``not_null``, and a key
with a NULL in it is neither a duplicate nor without its parent.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import as_ts, col_

VIOLATION_SCHEMA = "table_name string, check_name string, key string, n_rows long, row string"
RESULT_SCHEMA = "table_name string, check_name string, n_rows long, n_violations long, passed boolean"


@dataclass(frozen=True)
class RowCheck:
    """Violated by the rows for which ``good`` is false."""
    name: str
    good: Column


@dataclass(frozen=True)
class UniqueCheck:
    """Violated by all rows of a key that several rows have."""
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceCheck:
    """Violated by the rows whose key the parent does not have."""
    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class FreshCheck:
    """Violated (once) if the table's newest ``column`` is older than
    ``within`` before ``as_of``, or missing."""
    name: str
    column: str
    within: str
    as_of: object = None


Check = RowCheck | UniqueCheck | ReferenceCheck | FreshCheck


@dataclass(frozen=True)
class Checked:
    """A table with the columns that name a row, and its constraints."""
    rows: DataFrame
    key: tuple[str, ...]
    checks: list[Check] = field(default_factory=list)


def not_null(*columns: str) -> list[Check]:
    return [RowCheck(f"not_null_{c}", col_(c).isNotNull()) for c in columns]


def in_range(column: str, low=None, high=None) -> RowCheck:
    good = F.lit(True)
    if low is not None:
        good = good & (col_(column) >= low)
    if high is not None:
        good = good & (col_(column) <= high)
    return RowCheck(f"in_range_{column}", good)


def accepted(column: str, *values) -> RowCheck:
    return RowCheck(f"accepted_{column}", col_(column).isin(*values))


def holds(name: str, condition: Column | str) -> RowCheck:
    return RowCheck(name, F.expr(condition) if isinstance(condition, str) else condition)


def unique(*columns: str) -> UniqueCheck:
    return UniqueCheck(f"unique_{'_'.join(columns)}", columns)


def references(columns: list[str], parent: DataFrame, parent_columns: list[str], name: str) -> ReferenceCheck:
    return ReferenceCheck(f"references_{name}", tuple(columns), parent, tuple(parent_columns))


def fresh(column: str, within: str, as_of=None) -> FreshCheck:
    return FreshCheck(f"fresh_{column}", column, within, as_of)


class DataTestsFailed(RuntimeError):
    """Raised after the violations have been stored."""

    def __init__(self, failed: list[tuple[str, str, int]], path: str):
        self.failed = failed
        what = "; ".join(f"{t}.{c}: {n}" for t, c, n in failed)
        super().__init__(f"{len(failed)} data tests failed ({what}); rows in {path}")


def _key_text(columns: tuple[str, ...]) -> Column:
    """A key as text; NULL parts are shown."""
    return F.concat_ws("|", *[F.coalesce(col_(c).cast("string"), F.lit("NULL")) for c in columns])


def _violated(check: RowCheck) -> Column:
    return ~F.coalesce(check.good, F.lit(True))


def row_pass(name: str, table: Checked, path: str) -> dict[str, tuple[int, int]]:
    """{check: (rows, violations)} of the row and freshness constraints; bad
    rows are appended to ``path``, one for each constraint they violate."""
    rows = [c for c in table.checks if isinstance(c, RowCheck)]
    dated = [c for c in table.checks if isinstance(c, FreshCheck)]
    seen = Observation(f"checks_{name}")
    failed = F.filter(F.array(F.lit(None).cast("string"), *[F.when(_violated(c), F.lit(c.name)) for c in rows]),
                      lambda x: x.isNotNull())
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count(F.when(_violated(c), 1)).alias(f"r{i}") for i, c in enumerate(rows)]
    counts += [F.max(col_(c.column) >= as_ts(c.as_of) - F.expr(f"INTERVAL {c.within}")).alias(f"f{i}") for i, c in enumerate(dated)]
    bad = table.rows.select("*", failed.alias("_failed")).observe(seen, *counts).where(F.size("_failed") > 0)
    bad = bad.select(F.lit(name).alias("table_name"), F.explode("_failed").alias("check_name"),
                     _key_text(table.key).alias("key"), F.lit(1).cast("long").alias("n_rows"),
                     F.to_json(F.struct(*[col_(c) for c in table.rows.columns])).alias("row"))
    bad.write.mode("append").parquet(path)
    got = seen.get
    found = {c.name: (got["n"], got[f"r{i}"]) for i, c in enumerate(rows)}
    return found | {c.name: (got["n"], 0 if got[f"f{i}"] else 1) for i, c in enumerate(dated)}


def _tagged(rows: DataFrame, name: str, check: str, columns: tuple[str, ...], child: int) -> DataFrame:
    whole = F.lit(True)
    for c in columns:
        whole = whole & col_(c).isNotNull()
    return rows.where(whole).select(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"),
                                    _key_text(columns).alias("key"), F.lit(child).cast("long").alias("child"),
                                    F.lit(1 - child).cast("long").alias("parent"))


def key_violations(tables: dict[str, Checked]) -> DataFrame | None:
    """VIOLATION_SCHEMA rows of all key constraints: one for each bad key."""
    parts, uniques = [], []
    for name, table in tables.items():
        for c in table.checks:
            if isinstance(c, UniqueCheck):
                parts.append(_tagged(table.rows, name, c.name, c.columns, 1))
                uniques.append(c.name)
            elif isinstance(c, ReferenceCheck):
                parts.append(_tagged(table.rows, name, c.name, c.columns, 1))
                parts.append(_tagged(c.parent, name, c.name, c.parent_columns, 0))
    if not parts:
        return None
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    counted = every.groupBy("table_name", "check_name", "key").agg(F.sum("child").alias("n_rows"), F.sum("parent").alias("parents"))
    twice = F.col("check_name").isin(*sorted(set(uniques))) & (F.col("n_rows") > 1)
    orphan = ~F.col("check_name").isin(*sorted(set(uniques))) & (F.col("n_rows") > 0) & (F.col("parents") == 0)
    return counted.where(twice | orphan).select("table_name", "check_name", "key", "n_rows", F.lit(None).cast("string").alias("row"))


def run_checks(spark: SparkSession, tables: dict[str, Checked], path: str) -> DataFrame:
    """Check all tables; violations are stored under ``path`` (a new folder).
    One result row for each constraint."""
    results, rows = [], {}
    for name, table in tables.items():
        got = row_pass(name, table, path)
        rows[name] = next(iter(got.values()))[0] if got else table.rows.count()
        results += [(name, c, n, bad, bad == 0) for c, (n, bad) in got.items()]
    keys = key_violations(tables)
    if keys is not None:
        keys.write.mode("append").parquet(path)
        names = [(n, c.name) for n, t in tables.items() for c in t.checks if isinstance(c, (UniqueCheck, ReferenceCheck))]
        sums = {(r.table_name, r.check_name): r.n for r in violations(spark, path).where("row is null")
                .groupBy("table_name", "check_name").agg(F.sum("n_rows").alias("n")).collect()}
        results += [(n, c, rows[n], sums.get((n, c), 0), (n, c) not in sums) for n, c in names]
    return spark.createDataFrame(results, RESULT_SCHEMA)


def violations(spark: SparkSession, path: str) -> DataFrame:
    """What ``run_checks`` has stored."""
    return spark.read.schema(VIOLATION_SCHEMA).parquet(path)


def require(results: DataFrame, path: str) -> None:
    """Raise if any constraint is violated."""
    failed = [(r.table_name, r.check_name, r.n_violations) for r in results.where("not passed").orderBy("table_name", "check_name").collect()]
    if failed:
        raise DataTestsFailed(failed, path)
