"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once timed, into the no-op sink: every row and column is
computed, nothing is written. ``ingest`` is the whole write path (parse, pass, all tables, commit)
on the JSON feed as one batch. ``value`` is the sum of the timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "outcome_stream_volume", "ordering_fold", "current_state_volume", "notifications_volume",
    "outcome_counts_volume", "outcome_stream", "current_state", "parse_feed", "incremental_outcomes",
    "failed_events_upsert", "history_page", "retailer_page", "register_shipments", "lag_quantiles",
    "rates_sliding", "alerts",
)


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def ingest_time(spark: SparkSession, feed, work: str) -> float:
    """One batch into a fresh store; laying out the empty store is not timed."""
    from waybill.plans import fixtures as X
    from waybill.sources.store import Store
    from waybill.streaming import IngestConfig, ingest

    store = Store(spark, tempfile.mkdtemp(dir=work), X.KEY_TYPE).create()
    batch = store.begin()
    batch.put({"shipments": X.shipments(spark, SF_DIR)})
    store.commit(batch, "register", 0)
    return timed(lambda: ingest(feed, 0, store, IngestConfig(key_type="bigint", retries=0)))


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from waybill.plans import fixtures as X
    from waybill.plans.registry import QUERIES

    spark = session()
    work = tempfile.mkdtemp(prefix="bench-")
    seconds = {}
    for name in HEADLINE:
        def run(name=name):
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = timed(run)
        print(name, round(seconds[name], 3), file=sys.stderr, flush=True)

    X.feed_json(spark, SF_DIR, corrupt=True).write.parquet(f"{work}/feed")
    feed = spark.read.parquet(f"{work}/feed")
    ingest_time(spark, feed, work)
    seconds["ingest"] = ingest_time(spark, feed, work)
    rows_a, rows_b = feed.count(), X.table(spark, SF_DIR, "lineitem").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": SF_DIR.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
        "events_per_sec": {
            "outcome_stream_volume": round(rows_b / seconds["outcome_stream_volume"]),
            "current_state_volume": round(rows_b / seconds["current_state_volume"]),
            "ingest": round(rows_a / seconds["ingest"]),
        }}))
    spark.stop()


if __name__ == "__main__":
    main()
