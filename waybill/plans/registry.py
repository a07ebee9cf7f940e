"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model as M
from ..operators import dedupe, failures, fold, lookup, notify, outcome, pages, rates, reconcile, reports, state
from ..operators.skew import cut_lineage, find_heavy, scratch_folder
from ..operators.validate import validate_events
from ..sources import flatten_batches, parse_feed, read_feed
from ..sources.store import Store
from ..streaming import IngestConfig, ingest, tick
from . import fixtures as X
from .pipeline import assess, history_of, outcome_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = 86400
LAG_EDGES = [3600.0, 6 * 3600.0, 12 * 3600.0, 1.0 * DAY, 2.0 * DAY, 5.0 * DAY, 10.0 * DAY, 15.0 * DAY,
             20.0 * DAY, 25.0 * DAY, 28.0 * DAY]
QUANTILES = [0.5, 0.95, 0.99]
LATENCY_ALERT = 15.0 * DAY   # ingest lag of the test feed is counted in days
CONSUMER_DELAY = 1500        # seconds the test feed's consumer is behind


def query(build: Query) -> Query:
    """Registers ``build``; results carry plain timestamps in UTC, whatever the session's zone."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = build(spark, sf_dir)
        return df.select(*[
            F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema])
    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


class Feed:
    """Feed A and what the pipeline makes of it.

    ``written`` stands for outcomes that ingestion has stored: a checkpoint, for queries that read
    them more than once. Everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, written: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.vocab = None      # the built-in one
        self.categories = M.error_categories(spark)
        self.rules = M.notification_rules(spark)
        self.shipments = X.shipments(spark, sf_dir)
        self.events = X.feed_a(spark, sf_dir)
        self.written = written

    @cached_property
    def outcomes(self) -> DataFrame:
        outcomes = outcome_stream(self.events, self.shipments, self.vocab)
        return cut_lineage(outcomes) if self.written else outcomes

    @property
    def history(self) -> DataFrame:
        return history_of(self.outcomes)

    @property
    def state(self) -> DataFrame:
        return state.current_state(self.outcomes, self.shipments)

    @property
    def notifications(self) -> DataFrame:
        return notify.notifications_new(self.outcomes, self.rules)

    @property
    def failures(self) -> DataFrame:
        return outcome.failures_of(self.outcomes)

    @property
    def failed(self) -> DataFrame:
        return failures.failed_events_upsert(None, self.failures)


_OUTCOME = ["event_id", "arrival", "shipment_id", "carrier_code", "normalized_event_type", "outcome",
            "error_category", "received_at"]


# --- sources -------------------------------------------------------------------------------------

@query
def feed_scan(spark, sf):
    """The whole feed as the reader of files finds it."""
    folder = scratch_folder(spark)
    X.feed_json(spark, sf).write.parquet(folder)
    return read_feed(spark, folder)


@query
def feed_range(spark, sf):
    """A middle range of offsets of some partitions, through the reader."""
    folder = scratch_folder(spark)
    X.feed_json(spark, sf).write.parquet(folder)
    return read_feed(spark, folder, offsets={0: (50, 400), 2: (None, 300), 3: (100, None), 5: (None, None)})


@query
def parse_feed_query(spark, sf):
    df = parse_feed(X.feed_json(spark, sf, corrupt=True), key_type="bigint")
    return df.select("event_id", "schema_version", "shipment_id", "tracking_number", "carrier_code",
                     "event_type", "event_time", "sequence_number", "correlation_id", "payload_missing",
                     "malformed", "offset", "received_at")


@query
def flatten_batches_query(spark, sf):
    return flatten_batches(X.request_documents(spark, sf)).select("request_id", "position", "key", "value")


# --- projections and predicates ------------------------------------------------------------------

@query
def validate_events_query(spark, sf):
    return validate_events(X.feed_dirty(spark, sf)).select("arrival", "event_id", "violation")


@query
def normalize_events_query(spark, sf):
    f = Feed(spark, sf)
    return lookup.normalize_events(f.events, M.vocabulary(spark)).select(
        "event_id", "arrival", "carrier_code", "event_type", "carrier_supported", "normalized_event_type")


@query
def vocabulary_conflicts(spark, sf):
    return lookup.vocabulary_conflicts(X.registrations(spark, sf))


@query
def classify_outcome(spark, sf):
    f = Feed(spark, sf)
    heavy = find_heavy(f.events, ["event_id"]).get("event_id")
    flagged = dedupe.mark_duplicates(assess(f.events, f.shipments, f.vocab), heavy=heavy)
    return outcome.classify_outcome(flagged).select("event_id", "arrival", "outcome", "error_category")


@query
def bound_error_text(spark, sf):
    docs = X.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("error_type"), F.col("text").alias("error_message"))
    return failures.bound_error_text(docs)


@query
def shipment_view(spark, sf):
    return pages.shipment_view(Feed(spark, sf).state)


# --- joins ---------------------------------------------------------------------------------------

@query
def resolve_shipments(spark, sf):
    f = Feed(spark, sf)
    return lookup.resolve_shipments(f.events, f.shipments).select(
        "event_id", "arrival", "shipment_id", "carrier_code", "registered_carrier", "shipment_found",
        "carrier_matches")


class Batches:
    """Feed A as two overlapping batches; ``past`` is what ingesting the first one stored."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.vocab, self.rules = None, M.notification_rules(spark)
        self.shipments, self.events = X.shipments(spark, sf_dir), X.feed_a(spark, sf_dir)
        first, self.second = X.feed_a_batches(spark, sf_dir)
        self.past = cut_lineage(outcome_stream(first, self.shipments, self.vocab))
        self.history = history_of(self.past)
        self.state = state.current_state(self.past, self.shipments)

    def outcomes(self) -> DataFrame:
        return outcome_stream(self.second, self.state, self.vocab, self.history)


@query
def duplicates_semi(spark, sf):
    b = Batches(spark, sf)
    return dedupe.duplicates_semi(b.second, b.history).select("event_id", "arrival")


@query
def new_events_anti(spark, sf):
    b = Batches(spark, sf)
    return dedupe.new_events_anti(b.second, b.history).select("event_id", "arrival")


@query
def duplicate_report(spark, sf):
    f = Feed(spark, sf, written=True)
    repeated = f.outcomes.where(F.col("outcome") == "DUPLICATE")
    return dedupe.duplicate_report(repeated, f.history, f.state)


@query
def incremental_outcomes(spark, sf):
    """The second batch against the tables the first one left behind."""
    return Batches(spark, sf).outcomes().select(*_OUTCOME)


@query
def incremental_state(spark, sf):
    b = Batches(spark, sf)
    return state.current_state(b.outcomes(), b.state)


@query
def notifications_new(spark, sf):
    """All applied events, against the notifications the first batch made."""
    b = Batches(spark, sf)
    everything = outcome_stream(b.events, b.shipments, b.vocab)
    return notify.notifications_new(everything, b.rules, notify.notifications_new(b.past, b.rules))


@query
def notification_cause(spark, sf):
    f = Feed(spark, sf, written=True)
    return notify.notification_cause(f.notifications, f.history)


@query
def history_existence(spark, sf):
    f = Feed(spark, sf, written=True)
    return pages.history_existence(f.events, f.shipments, f.history)


@query
def shipment_consistency(spark, sf):
    f = Feed(spark, sf, written=True)
    return reports.shipment_consistency(f.state, f.history)


@query
def backfill_last_received(spark, sf):
    f = Feed(spark, sf, written=True)
    before = f.state.withColumn("last_received_at", F.lit(None).cast("timestamp"))
    return state.backfill_last_received(before, f.history).select("shipment_id", "last_event_time", "last_received_at")


# --- windows and reductions ----------------------------------------------------------------------

@query
def mark_duplicates(spark, sf):
    f = Feed(spark, sf)
    heavy = find_heavy(f.events, ["event_id"]).get("event_id")   # cheaper on the raw events
    return dedupe.mark_duplicates(assess(f.events, f.shipments, f.vocab), heavy=heavy).select("event_id", "arrival", "is_duplicate")


@query
def ordering_fold(spark, sf):
    """The fold alone, over every line item as a stored scan of its order."""
    scans = lookup.normalize_events(X.feed_b(spark, sf))
    return fold.ordering_fold(scans).select("event_id", "shipment_id", "offset", "event_time", "sequence_number",
                         "normalized_event_type", "applied")


@query
def outcome_stream_query(spark, sf):
    return Feed(spark, sf).outcomes.select(*_OUTCOME)


@query
def current_state(spark, sf):
    return Feed(spark, sf).state


@query
def shipments_upsert(spark, sf):
    """Deltas of the first batch applied to a snapshot, then those of the second."""
    b = Batches(spark, sf)
    first = state.shipments_upsert(b.shipments, state.state_deltas(b.past))
    return state.shipments_upsert(first, state.state_deltas(b.outcomes())).select(
        "shipment_id", "current_status", "last_event_time", "last_sequence_number", "last_received_at",
        "version", "updated_at")


@query
def applied_timeline(spark, sf):
    f = Feed(spark, sf)
    heavy = find_heavy(f.events, ["shipment_id"]).get("shipment_id")
    return fold.applied_timeline(f.outcomes.where("stored"), heavy=heavy).select(
        "event_id", "shipment_id", "arrival", "applied", "status_before", "status_after")


# --- failures ------------------------------------------------------------------------------------

@query
def failed_events_upsert(spark, sf):
    """Failures of the second batch upserted into the table the first one left."""
    b = Batches(spark, sf)
    snapshot = failures.failed_events_upsert(None, outcome.failures_of(b.past))
    return failures.failed_events_upsert(snapshot, outcome.failures_of(b.outcomes()))


@query
def dead_letters(spark, sf):
    return failures.dead_letters(Feed(spark, sf).failures)


@query
def retry_schedule(spark, sf):
    f = Feed(spark, sf)
    return failures.retry_schedule(f.failures, f.categories)


@query
def replay_eligible(spark, sf):
    f = Feed(spark, sf)
    return failures.replay_eligible(f.failed, f.categories).select(
        "failed_event_id", "event_id", "shipment_id", "error_category", "retry_count", "status")


@query
def replay_result(spark, sf):
    """Replay after the missing shipments were registered."""
    f = Feed(spark, sf, written=True)
    eligible = failures.replay_eligible(f.failed, f.categories)
    again = parse_feed(eligible.select(
        "failed_event_id", F.col("payload").alias("value"), F.col("original_topic").alias("topic"),
        F.col("original_partition").alias("partition"), F.col("original_offset").alias("offset"),
        F.col("last_failed_at").alias("timestamp")), key_type="bigint")
    registered = state.current_state(f.outcomes, X.all_customers(spark, sf))
    second = outcome_stream(again, registered, f.vocab, f.history)
    failed_again = outcome.failures_of(second).withColumn("_again", F.lit(True))
    attempts = (eligible.select("failed_event_id", "event_id")
                .join(failed_again.select("event_id", "error_category", "error_type", "error_message",
                                          "failed_at"), "event_id", "left"))
    return failures.replay_result(f.failed, attempts).select(
        "failed_event_id", "event_id", "error_category", "error_type", "error_message", "retry_count",
        "status", "version")


# --- commands ------------------------------------------------------------------------------------

@query
def register_shipments(spark, sf):
    return state.register_shipments(X.requests(spark, sf), X.shipments(spark, sf)).select(
        "shipment_id", "request_id", "retailer_id", "customer_id", "tracking_number", "carrier_code",
        "current_status", "estimated_delivery_date", "version", "created_at")


@query
def register_rejected(spark, sf):
    return state.register_rejected(X.requests(spark, sf), X.shipments(spark, sf))


@query
def revise_estimates(spark, sf):
    return state.revise_estimates(X.revisions(spark, sf), X.shipments(spark, sf)).select(
        "shipment_id", "estimated_delivery_date", "created_at", "updated_at")


# --- pages and lookups ---------------------------------------------------------------------------

@query
def history_page(spark, sf):
    f = Feed(spark, sf, written=True)
    return pages.history_page(f.history, f.shipments, page=1, size=15)


@query
def notifications_page(spark, sf):
    f = Feed(spark, sf, written=True)
    return pages.notifications_page(f.notifications, f.shipments, page=0, size=10)


@query
def retailer_page(spark, sf):
    return pages.retailer_page(Feed(spark, sf, written=True).state, page=0, size=20)


@query
def retailer_status_page(spark, sf):
    return pages.retailer_page(Feed(spark, sf, written=True).state, status="LABEL_CREATED", page=1, size=7)


@query
def failed_events_page(spark, sf):
    f = Feed(spark, sf, written=True)
    return pages.failed_events_page(f.failed, f.categories, status="FAILED", page=1, size=100)


@query
def history_page_after(spark, sf):
    """The page after the second one's last rows."""
    f = Feed(spark, sf, written=True)
    cursors = cut_lineage(pages.last_rows(pages.history_page(f.history, f.shipments, page=1, size=15), "shipment_id"))
    return pages.history_after(f.history, cursors, size=15)


@query
def notifications_page_after(spark, sf):
    f = Feed(spark, sf, written=True)
    first = pages.notifications_page(f.notifications, f.shipments, page=0, size=5)
    cursors = cut_lineage(pages.last_rows(first, "shipment_id", pages.NOTIFICATION_ORDER))
    return pages.notifications_after(f.notifications, cursors, size=5)


@query
def retailer_page_after(spark, sf):
    f = Feed(spark, sf, written=True)
    cursors = cut_lineage(pages.last_rows(pages.retailer_page(f.state, page=0, size=3), "retailer_id", pages.RETAILER_ORDER))
    return pages.retailer_after(f.state, cursors, size=3)


@query
def failed_events_page_after(spark, sf):
    """The third page, each found from the last row of the one before."""
    f, last = Feed(spark, sf, written=True), None
    failed = cut_lineage(f.failed)
    for _ in range(2):
        page = pages.failed_events_after(failed, f.categories, last, status="FAILED", size=20).collect()   # a page
        last = page[-1].asDict()
    return pages.failed_events_after(failed, f.categories, last, status="FAILED", size=20)


@query
def shipment_look_up(spark, sf):
    """Every shipment the feed names, found or not."""
    f = Feed(spark, sf)
    return pages.look_up(f.events, f.state, "shipment_id", pages.shipment_view)


@query
def failed_event_look_up(spark, sf):
    """The failed event of every event the feed names, if it has one."""
    f = Feed(spark, sf, written=True)
    return pages.look_up(f.events, f.failed, "event_id", lambda df: pages.failed_event_view(df, f.categories))


@query
def history_by_tracking_number(spark, sf):
    f = Feed(spark, sf)
    return pages.history_by_tracking_number(f.history, f.shipments)


@query
def recent_ingest(spark, sf):
    return pages.recent_ingest(Feed(spark, sf).history, 100)


# --- reports -------------------------------------------------------------------------------------

@query
def outcome_counts(spark, sf):
    return reports.outcome_counts(Feed(spark, sf).outcomes)


def ingested(spark, sf) -> Store:
    """A store that has taken in the whole feed from its wire form, and waited until all retries were over."""
    store = Store(spark, scratch_folder(spark), X.KEY_TYPE).create()
    batch = store.begin()
    batch.put({"shipments": X.shipments(spark, sf)})
    store.commit(batch, "register", 0)
    config = IngestConfig(key_type="bigint")
    ingest(X.feed_json(spark, sf), 0, store, config)
    tick(store, config, datetime.fromtimestamp(store.log().feed_clock / 1e6) + timedelta(seconds=10))
    return store


@query
def attempt_counts(spark, sf):
    """From the tries that ingestion stored."""
    return reports.attempt_counts(ingested(spark, sf).read("outcomes"))


@query
def failures_by_category(spark, sf):
    f = Feed(spark, sf)
    return reports.failures_by_category(f.outcomes, f.categories)


@query
def notification_counts(spark, sf):
    f = Feed(spark, sf)
    return notify.notification_counts(f.notifications, f.rules)


@query
def notification_skips(spark, sf):
    b = Batches(spark, sf)
    everything = outcome_stream(b.events, b.shipments, b.vocab)
    return notify.notification_skips(everything, b.rules, M.skip_reasons(spark),
                                     notify.notifications_new(b.past, b.rules))


@query
def backlog_gauges(spark, sf):
    f = Feed(spark, sf, written=True)
    return reports.backlog_gauges(f.state, f.failed)


@query
def status_distribution(spark, sf):
    return reports.status_distribution(Feed(spark, sf).state)


@query
def version_invariant(spark, sf):
    f = Feed(spark, sf, written=True)
    return reports.version_invariant(f.state, f.history)


@query
def lag_histogram(spark, sf):
    return reports.lag_histogram(Feed(spark, sf).history, LAG_EDGES)


@query
def lag_quantiles(spark, sf):
    return reports.lag_quantiles(reports.lag_histogram(Feed(spark, sf).history, LAG_EDGES), QUANTILES)


@query
def duration_histogram(spark, sf):
    return reports.duration_histogram(Feed(spark, sf).outcomes, LAG_EDGES)


@query
def partition_lag(spark, sf):
    first, _ = X.feed_a_batches(spark, sf)
    ends = X.feed_a(spark, sf).groupBy("topic", "partition").agg(F.max("offset").alias("end_offset"))
    committed = first.groupBy("topic", "partition").agg(F.max("offset").alias("committed_offset"))
    return reports.partition_lag(ends, committed)


@query
def reconciliation(spark, sf):
    f = Feed(spark, sf, written=True)
    sent = f.events.agg(F.count("*").alias("events"),
                        (F.count("*") - F.count_distinct("event_id")).alias("duplicates"),
                        F.lit(None).cast("long").alias("out_of_order"))
    return reconcile.reconciliation(sent, f.outcomes, f.history, f.failed)


@query
def reconciliation_dead_letters(spark, sf):
    """The same with refused deliveries against dead letters, as both count deliveries."""
    f = Feed(spark, sf, written=True)
    sent = f.events.agg(F.count("*").alias("events"),
                        (F.count("*") - F.count_distinct("event_id")).alias("duplicates"),
                        F.lit(None).cast("long").alias("out_of_order"))
    return reconcile.reconciliation(sent, f.outcomes, f.history, f.failed, failures.dead_letters(f.failures))


@query
def reconcile_except(spark, sf):
    f = Feed(spark, sf, written=True)
    return reconcile.reconcile_except(f.events, f.history)


@query
def counter_deltas(spark, sf):
    b = Batches(spark, sf)
    everything = outcome_stream(b.events, b.shipments, b.vocab)
    span = b.events.agg(F.count("*").alias("n")).select((F.col("n") / 2.0)).scalar()
    return reconcile.counter_deltas(reports.counter_rows(b.past), reports.counter_rows(everything), span)


# --- rates and alerts ----------------------------------------------------------------------------

@query
def event_rates(spark, sf):
    return rates.event_rates(Feed(spark, sf).outcomes)


@query
def failure_rates(spark, sf):
    return rates.failure_rates(Feed(spark, sf).outcomes)


@query
def rates_sliding(spark, sf):
    return rates.rates_sliding(Feed(spark, sf).outcomes)


@query
def rates_by_carrier(spark, sf):
    return rates.rates_by_carrier(Feed(spark, sf).outcomes)


@query
def failure_ratio(spark, sf):
    return rates.failure_ratio(Feed(spark, sf).outcomes)


@query
def lag_quantiles_by_window(spark, sf):
    return rates.lag_quantiles_by_window(Feed(spark, sf).outcomes, QUANTILES, LAG_EDGES)


@query
def notification_rates(spark, sf):
    return rates.notification_rates(Feed(spark, sf).notifications)


@query
def notification_skip_rates(spark, sf):
    b = Batches(spark, sf)
    everything = outcome_stream(b.events, b.shipments, b.vocab)
    return rates.skip_rates(notify.skipped_events(everything, b.rules, notify.notifications_new(b.past, b.rules)))


@query
def silence(spark, sf):
    f = Feed(spark, sf, written=True)
    return rates.silence(f.outcomes, rates.time_spine(f.outcomes, 60, extra=3600))


@query
def alerts(spark, sf):
    f = Feed(spark, sf, written=True)
    rules = rates.AlertRules(latency=LATENCY_ALERT)
    return rates.alerts(f.outcomes, X.gauges(f.outcomes, CONSUMER_DELAY), LAG_EDGES, rules, extra=3600)


# --- volume --------------------------------------------------------------------------------------

def _volume(spark, sf):
    return outcome_stream(X.feed_b(spark, sf), X.feed_b_shipments(spark, sf))


@query
def outcome_stream_volume(spark, sf):
    return _volume(spark, sf).select("event_id", "shipment_id", "offset", "event_time", "sequence_number",
                                     "normalized_event_type", "outcome", "received_at")


@query
def current_state_volume(spark, sf):
    return state.current_state(_volume(spark, sf), X.feed_b_shipments(spark, sf))


@query
def status_distribution_volume(spark, sf):
    return reports.status_distribution(
        state.current_state(_volume(spark, sf), X.feed_b_shipments(spark, sf)))


@query
def notifications_volume(spark, sf):
    return notify.notifications_new(_volume(spark, sf), M.notification_rules(spark))


@query
def outcome_counts_volume(spark, sf):
    return reports.outcome_counts(_volume(spark, sf))


# functions whose operator shares their name are registered under the operator's
for _name in [n for n in QUERIES if n.endswith("_query")]:
    QUERIES[_name.removesuffix("_query")] = QUERIES.pop(_name)
