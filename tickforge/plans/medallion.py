"""Stage order bronze -> silver -> gold -> marts -> tests, batch and streaming.

Each stage writes a table to a folder; the next stage reads that folder,
which also cuts the lineage between stages (a lost executor only
recomputes from the last written table).  Marts are rebuilt in full and
written with overwrite, as the upstream models are materialised.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import config, schemas
from tickforge.operators import candles as candle_ops
from tickforge.operators import checks, history, marts, partials, rollups, sentiment, silver
from tickforge.plans.contracts import lake_checks
from tickforge.session import library_session
from tickforge.sources.streams import lake_table, message_files
from tickforge.sources.warehouse import Warehouse
from tickforge.streaming import incremental, stages
from tickforge.streaming.sinks import DATE, BatchFileSink, read_latest, with_date

CANDLES, HOURLY, SENTIMENT = "fact_market_candles", "hourly_ingestion", "fact_market_sentiment"
MARTS = ("mart_market_overview", "mart_ohlc_summary", "mart_pipeline_health", "mart_price_vs_sentiment")


@dataclass
class LakePaths:
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    @property
    def landing(self):
        return f"{self.root}/landing"

    @property
    def bronze(self):
        return f"{self.root}/bronze"

    @property
    def silver(self):
        return f"{self.root}/silver"

    @property
    def gold(self):
        return f"{self.root}/gold"

    @property
    def candles(self):
        """The candle table: one row per key, by day."""
        return f"{self.root}/{CANDLES}"

    @property
    def history(self):
        return f"{self.root}/history"

    @property
    def sentiment(self):
        return f"{self.root}/{SENTIMENT}"

    @property
    def partials(self):
        """Mergeable candle states, one bucket a day."""
        return f"{self.root}/candle_states"

    @property
    def hours(self):
        """Hourly candle states, one bucket a day."""
        return f"{self.root}/candle_hours"

    @property
    def tests(self):
        """Violations found by the data tests, one folder for each run."""
        return f"{self.root}/_tests"

    @property
    def marts(self):
        return f"{self.root}/marts"

    def warehouse(self, spark: SparkSession) -> Warehouse:
        """The lake's tables by name."""
        places = {name: f"{self.marts}/{name}" for name in MARTS}
        return Warehouse(spark, {**places, CANDLES: self.candles, HOURLY: f"{self.root}/{HOURLY}"})

    def checkpoint(self, stage: str) -> str:
        return f"{self.root}/_checkpoints/{stage}"


def write_silver(trades: DataFrame, path: str, processed_at=None,
                 rebalance: bool = True) -> None:
    """Batch silver: the de-duplication aggregate, then a partitioned write.

    The ``rebalance`` hint clusters rows by day so each task writes few
    files, and lets AQE split a day that holds a large share of the rows
    over several tasks (a plain repartition by day would give a hot day
    to one task) and merge small days.  It is a second shuffle of the
    rows: worth it for a backfill over many days, where every
    de-duplication reducer would otherwise write a small file per day.
    An incremental run over a day or two can pass ``rebalance=False``:
    each reducer then writes one or two files of its (AQE-sized) output.
    """
    out = silver.silver_batch(trades, processed_at)
    if rebalance:
        out = out.hint("rebalance", *schemas.SILVER_PARTITIONS)
    out.write.mode("overwrite").partitionBy(*schemas.SILVER_PARTITIONS).parquet(path)


def write_candles(spark: SparkSession, candles_df: DataFrame, lake: LakePaths) -> None:
    """Store the candle table, partitioned by day: a window's test prunes
    files.  ``rebalance`` groups rows by day and splits a large day."""
    lake.warehouse(spark).materialize(CANDLES, with_date(candles_df).hint("rebalance", DATE), [DATE])


def build_marts(spark: SparkSession, lake: LakePaths, as_of) -> dict[str, str]:
    """Rebuild the four marts (overwrite) from the stored candle table and
    the stored sentiment dimension; the hourly table is written once, for the
    health mart's aggregates.  The health and price marts are stored in their
    contract's order."""
    tables = lake.warehouse(spark)
    candles_df = tables.source(CANDLES)
    tables.materialize(HOURLY, marts.hourly_ingestion(candles_df))
    sentiment_df = sentiment.stored(spark, lake.sentiment).rows()
    built = {
        "mart_market_overview": marts.market_overview(candles_df, as_of),
        "mart_ohlc_summary": marts.ohlc_summary(candles_df),
        "mart_pipeline_health": marts.pipeline_health(candles_df, as_of, ordered=False, hourly=tables.source(HOURLY)),
        "mart_price_vs_sentiment": marts.price_vs_sentiment(candles_df, sentiment_df, ordered=False),
    }
    order = {"mart_pipeline_health": marts.health_order(), "mart_price_vs_sentiment": marts.prices_order()}
    return {name: tables.materialize(name, df, order_by=order.get(name)) for name, df in built.items()}


def run_tests(spark: SparkSession, lake: LakePaths, as_of, fresh_within: str = "24 hours",
              fail: bool = True) -> DataFrame:
    """Check the lake's tables against their constraints (``plans.contracts``)
    after the marts are built.  Violating rows are stored under ``lake.tests``;
    with ``fail`` a violation raises, so what is to run next does not."""
    spark = library_session(spark)
    tables = lake.warehouse(spark)
    frames = {name: tables.source(name) for name in (CANDLES, *MARTS)}
    frames[SENTIMENT] = sentiment.stored(spark, lake.sentiment).rows()
    path = f"{lake.tests}/run={uuid.uuid4().hex}"
    results = checks.run_checks(spark, lake_checks(frames, as_of, fresh_within), path)
    if fail:
        checks.require(results, path)
    return results


def run_batch(spark: SparkSession, trades: DataFrame, sentiment_df: DataFrame,
              lake: LakePaths, as_of, processed_at=None) -> dict[str, str]:
    """Trades -> silver table -> candle table -> marts, each stage written;
    ``sentiment_df`` is upserted into the stored dimension."""
    spark = library_session(spark)
    write_silver(trades, lake.silver, processed_at)
    write_candles(spark, candle_ops.candles(lake_table(spark, lake.silver), ingested_at=processed_at), lake)
    sentiment.store_latest(spark, sentiment_df, lake.sentiment)
    return build_marts(spark, lake, as_of)


def load_history(spark: SparkSession, lake: LakePaths, day=None) -> None:
    """Silver lake -> history table, all days or one: only the days loaded
    are replaced, so a load can be repeated."""
    history.write_history(history.history_rows(lake_table(spark, lake.silver), day), lake.history)


def gold_table(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """The gold stream's candles, the copy written last of each key."""
    return read_latest(spark, lake.gold, ["symbol", "candle_start_time"]).select(*schemas.CANDLE_COLUMNS)


def merged_candles(spark: SparkSession, lake: LakePaths, ingested_at=None) -> DataFrame:
    """Candles of the stored states: late trades are in them."""
    return partials.candles_from(partials.stored(spark, lake.partials).rows(), ingested_at)


def run_partials(spark: SparkSession, lake: LakePaths, timeout_s: float | None = None) -> None:
    """New silver trades -> the stored candle states."""
    stages.await_done(stages.start_partials(library_session(spark), lake.silver, lake.partials,
                                            lake.checkpoint("partials")), timeout_s)


def rolled_overview(spark: SparkSession, lake: LakePaths, as_of=None) -> DataFrame:
    """The overview at a clock from the stored hourly states, which are first
    brought up to date with the minutes."""
    hours, minutes = partials.stored(spark, lake.hours), partials.stored(spark, lake.partials)
    rollups.refresh_hours(hours, minutes)
    return rollups.stored_overview(spark, hours, minutes, as_of)


def run_incremental(spark: SparkSession, lake: LakePaths, processed_at=None, checkpoint: str = "bronze-hours",
                    timeout_s: float | None = None, archive: bool = True,
                    files_per_partition: int | None = 1) -> int | None:
    """Landed messages -> bronze hours -> a silver load -> the candle states,
    each taking only what is new; returns the silver load's number.  A
    redelivery adds nothing (``streaming.incremental``)."""
    spark = library_session(spark)
    landed = message_files(spark, lake.landing, archive=f"{lake.root}/landing_done" if archive else None)
    stages.await_done(stages.start_bronze_hours(landed, lake.bronze, lake.checkpoint(checkpoint),
                                                files_per_partition=files_per_partition), timeout_s)
    states = partials.stored(spark, lake.partials)
    number = incremental.load_silver(spark, lake.bronze, lake.silver, processed_at)
    # also loads that a run before has left without their candles
    for n in incremental.loads_between(spark, lake.silver, states.commit().applied.get("silver", 0)):
        rows = incremental.silver_rows(spark, lake.silver).where(F.col("load") == n)
        states.merge(partials.partial_candles(rows), partials.merge, ("silver", n))
    return number


def compact_silver(spark: SparkSession, lake: LakePaths, **how) -> list[str]:
    """Compact the closed days of the silver loads, once the candle states have
    all of them (``incremental.compact``)."""
    spark = library_session(spark)
    if incremental.loads_between(spark, lake.silver, partials.stored(spark, lake.partials).commit().applied.get("silver", 0)):
        return []
    return incremental.compact(spark, lake.silver, **how)


def run_streaming(spark: SparkSession, lake: LakePaths, processed_at=None,
                  timeout_s: float | None = None,
                  state_partitions: int | None = None, first_seen: bool = True,
                  files_per_partition: int | None = None) -> DataFrame:
    """Landed messages -> bronze -> silver -> gold, one run-once query per
    stage, in order; returns the gold candles (latest copy per key).
    ``first_seen``: the silver de-duplication mode (``silver.silver_stream``)."""
    spark = library_session(spark)
    stages.await_done(stages.start_bronze(message_files(spark, lake.landing), lake.bronze, lake.checkpoint("bronze"),
                                          files_per_partition=files_per_partition), timeout_s)
    stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver,
                                          lake.checkpoint("silver"), processed_at=processed_at,
                                          state_partitions=state_partitions, first_seen=first_seen,
                                          files_per_partition=files_per_partition), timeout_s)
    stages.await_done(stages.start_gold_batches(spark, lake.silver, BatchFileSink(lake.gold),
                                                lake.checkpoint("gold"), ingested_at=processed_at,
                                                state_partitions=state_partitions), timeout_s)
    return gold_table(spark, lake)


def build_marts_from_lake(spark: SparkSession, lake: LakePaths, as_of,
                          sentiment_df: DataFrame | None = None) -> dict[str, str]:
    """Marts after ``run_streaming``: the gold folder's latest candles are
    stored once as the candle table, new sentiment rows are upserted."""
    spark = library_session(spark)
    write_candles(spark, gold_table(spark, lake), lake)
    if sentiment_df is not None:
        sentiment.store_latest(spark, sentiment_df, lake.sentiment)
    return build_marts(spark, lake, as_of)


def main(argv: list[str] | None = None, stop_session: bool = False) -> None:
    """Command line: run the stages in order against one lake root.

    python -m tickforge.plans.medallion --lake s3a://lake --kafka host:9092 \\
        --topic trades --stages bronze,silver,gold,marts,tests --as-of '2024-01-31 00:00:00'
    """
    import argparse

    from tickforge.session import build_session
    from tickforge.sources.streams import kafka_messages, landed_documents
    from tickforge.streaming.sinks import JdbcSink

    ap = argparse.ArgumentParser(prog="tickforge")
    ap.add_argument("--lake", required=True)
    ap.add_argument("--kafka", help="bootstrap servers; default reads <lake>/landing files")
    ap.add_argument("--topic")
    ap.add_argument("--stages", default="bronze,silver,gold,marts,tests",
                    help="any of bronze,silver,gold,partials,sentiment,history,marts,tests; run in that order; with "
                         "partials the marts are built from the merged states, which late trades enter")
    ap.add_argument("--as-of", help="mart clock, 'YYYY-MM-DD HH:MM:SS' (default: now)")
    ap.add_argument("--fresh-within", default="24 hours", help="tests: how old the newest candle may be")
    ap.add_argument("--day", help="history: load this day only, 'YYYY-MM-DD'")
    ap.add_argument("--sentiment-docs", help="folder of landed sentiment API documents")
    ap.add_argument("--jdbc-url", help="gold: also append candles to this database")
    ap.add_argument("--jdbc-table", default=CANDLES)
    ap.add_argument("--jdbc-connections", type=int, default=None)
    ap.add_argument("--timeout", type=float, default=None)
    ap.add_argument("--state-partitions", type=int, default=None,
                    help="state partitions of the silver and gold streams; fixed at their first start")
    ap.add_argument("--files-per-partition", type=int, default=None,
                    help="most files that a bronze or silver micro-batch writes into a partition folder")
    ap.add_argument("--max-files-per-trigger", type=int, default=None,
                    help="bound each micro-batch of the bronze stream, which has no state")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=None,
                    help="the same for the Kafka source")
    ap.add_argument("--dedupe", choices=["first-seen", "first-arrival"], default="first-seen",
                    help="silver stream: keep the first copy seen (at once), or the first arrival "
                         "by ingest time (deterministic, combined before the shuffle, emitted "
                         "after the watermark)")
    args = ap.parse_args(argv)
    spark = library_session(build_session(app="tickforge-medallion"))
    lake = LakePaths(args.lake)
    wanted = [s.strip() for s in args.stages.split(",") if s.strip()]
    if unknown := set(wanted) - {"bronze", "silver", "gold", "partials", "sentiment", "history", "marts", "tests"}:
        ap.error(f"unknown stages: {', '.join(sorted(unknown))}")
    if "bronze" in wanted:
        src = (kafka_messages(spark, args.kafka, args.topic,
                              max_offsets_per_trigger=args.max_offsets_per_trigger)
               if args.kafka else message_files(spark, lake.landing, args.max_files_per_trigger))
        stages.await_done(stages.start_bronze(src, lake.bronze, lake.checkpoint("bronze"),
                                              files_per_partition=args.files_per_partition), args.timeout)
    if "silver" in wanted:
        stages.await_done(stages.start_silver(spark, lake.bronze, lake.silver,
                                              lake.checkpoint("silver"),
                                              state_partitions=args.state_partitions,
                                              files_per_partition=args.files_per_partition,
                                              first_seen=args.dedupe == "first-seen"),
                          args.timeout)
    if "gold" in wanted:
        sinks = {"gold": BatchFileSink(lake.gold)}
        if args.jdbc_url:
            sinks["gold-jdbc"] = JdbcSink(args.jdbc_url, args.jdbc_table, num_partitions=args.jdbc_connections)
        for name, sink in sinks.items():
            stages.await_done(stages.start_gold_batches(spark, lake.silver, sink, lake.checkpoint(name),
                                                        state_partitions=args.state_partitions), args.timeout)
    if "partials" in wanted:
        run_partials(spark, lake, args.timeout)
    if "sentiment" in wanted:
        if not args.sentiment_docs:
            ap.error("the sentiment stage needs --sentiment-docs")
        sentiment.store_latest(spark, sentiment.parse_documents(landed_documents(spark, args.sentiment_docs)),
                               lake.sentiment)
    if "history" in wanted:
        load_history(spark, lake, args.day)
    if "marts" in wanted:
        if "partials" in wanted:
            write_candles(spark, merged_candles(spark, lake), lake)
            build_marts(spark, lake, args.as_of)
        else:
            build_marts_from_lake(spark, lake, args.as_of)
    if "tests" in wanted:
        run_tests(spark, lake, args.as_of, args.fresh_within)
    if stop_session:
        spark.stop()


if __name__ == "__main__":
    main(stop_session=True)
