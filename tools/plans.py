"""Summarise the physical plan of every registered query (after AQE).

usage: python tools/plans.py [sf_dir] > PLANS.md

Runs each query of the catalog (counting rows in the JVM) so adaptive re-planning has happened,
then reports scans (read columns, pushed/partition filters), exchanges,
aggregate kinds, joins, windows and generators.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["Exchange", "ReusedExchange", "BroadcastExchange", "HashAggregate", "SortAggregate",
         "ObjectHashAggregate", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Generate", "Scan",
         "Sort", "StateStoreSave", "Expand"]

# Longer plan lines are cut.
WIDTH = 220


def summarize(df) -> dict:
    # Run this DataFrame's own query execution (rows are counted in the JVM),
    # so its adaptive plan is the final, re-planned one.
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    final = plan
    m = re.search(r"Final Plan ==\n(.*?)(\+- == Initial Plan|\Z)", plan, re.S)
    if m:
        final = m.group(1)
    counts = Counter()
    for line in final.splitlines():
        node = re.sub(r"^[\s:+\-*()0-9]*", "", line)
        if node.startswith("FileScan ") or node.startswith("Scan "):   # file scans, any format
            counts["Scan"] += 1
            continue
        for n in NODES:
            if node.startswith(n):
                counts[n] += 1
                break
    return {"counts": dict(counts), "plan": final}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tickforge.session import build_session
    from tickforge.plans.catalog import QUERIES
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plans.py` on `{sf}` after execution (adaptive plans final). "
          "Counts are plan nodes; queries that write tables or run streams show the plan of the read-back; the plans of the writes and of a micro-batch are at the end.\n")
    print("| query | scans | exchanges | hash agg | sort agg | joins | windows | generators |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name, q in QUERIES.items():
        df = q(spark, sf)
        s = summarize(df)
        c = s["counts"]
        joins = ", ".join(f"{k}×{v}" for k, v in c.items() if "Join" in k) or "–"
        print(f"| {name} | {c.get('Scan', 0)} | {c.get('Exchange', 0)} "
              f"(+{c.get('BroadcastExchange', 0)} bcast, {c.get('ReusedExchange', 0)} reused) | "
              f"{c.get('HashAggregate', 0)} | {c.get('SortAggregate', 0)} | {joins} | "
              f"{c.get('Window', 0)} | {c.get('Generate', 0)} |")
        details.append((name, s["plan"]))
    print("\n## Final plans\n")
    seen = {}
    for name, plan in details + written_plans(spark, sf):
        text = "\n".join(line[:WIDTH] for line in plan.strip().splitlines())
        shape = re.sub(r"#\d+L?|plan_id=\d+|\[file:[^\]]*\]", "", text)
        if shape in seen:
            print(f"### {name}\n\nAs {seen[shape]}.\n")
            continue
        seen[shape] = name
        print(f"### {name}\n\n```\n{text}\n```\n")
    spark.stop()


def written_plans(spark, sf) -> list[tuple[str, str]]:
    """The silver write, the candle write, and the last micro-batch of the
    silver and gold streams."""
    from tickforge import schemas
    from tickforge.operators import candles, silver
    from tickforge.plans import medallion
    from tickforge.plans.catalog import _land_messages, _trades
    from tickforge.session import run_dir
    from tickforge.sources.streams import lake_table, message_files
    from tickforge.streaming import stages
    from tickforge.streaming.sinks import DATE, BatchFileSink, with_date

    lake = medallion.LakePaths(run_dir(spark, "plans"))
    batch = silver.silver_batch(_trades(spark, sf))
    rows = [("write: silver", summarize(batch.hint("rebalance", *schemas.SILVER_PARTITIONS))["plan"])]
    _land_messages(spark, sf, lake)
    stages.await_done(stages.start_bronze(message_files(spark, lake.landing), lake.bronze, lake.checkpoint("bronze")))
    q = stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver, lake.checkpoint("silver"), first_seen=False))
    rows.append(("micro-batch: silver", q._jsq.streamingQuery().lastExecution().executedPlan().toString()))
    q = stages.await_done(stages.start_gold_batches(spark, lake.silver, BatchFileSink(lake.gold), lake.checkpoint("gold")))
    rows.append(("micro-batch: gold", q._jsq.streamingQuery().lastExecution().executedPlan().toString()))
    table = with_date(candles.candles(lake_table(spark, lake.silver))).hint("rebalance", DATE)
    rows.append(("write: candles", summarize(table)["plan"]))
    return rows


if __name__ == "__main__":
    main()
