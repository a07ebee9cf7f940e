"""Write-side commands in bulk: registration, estimate revisions, replay of failed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..operators.failures import replay_eligible, replay_result
from ..operators.outcome import failures_of
from ..operators.skew import cut_lineage
from ..operators.state import register_shipments, revise_estimates
from ..plans.pipeline import outcome_stream
from ..sources.feed import parse_feed
from ..sources.store import Log, Store
from .ingest import IngestConfig, publish, stored_for


def register(store: Store, requests: DataFrame, batch: int) -> None:
    """Registers shipments. A request that comes again finds its shipment registered, so reruns are
    harmless and every batch is read, whatever its number."""
    with store.writing():
        log = store.log()
        new = store.begin(log)
        numbers = requests.select("carrier_code", "tracking_number")
        new.put({"shipments": register_shipments(requests, store.read("shipments", numbers.distinct(), log))})
        store.commit(new, "register", batch)


def revise(store: Store, revisions: DataFrame, batch: int) -> None:
    """Replaces delivery estimates; a rerun replaces them by the same."""
    with store.writing():
        log = store.log()
        new = store.begin(log)
        touched = store.read("shipments", revisions.select("shipment_id").distinct(), log)
        new.put({"shipments": revise_estimates(revisions, touched)})
        store.commit(new, "revise", batch)


def replay(store: Store, batch: int, clock, ids: DataFrame | None = None,
           config: IngestConfig = IngestConfig()) -> None:
    """Processes open failed events again: all a replay can help, or those in ``ids``.

    They take the normal pass against the tables as they are now, received at ``clock``. One that
    is stored meanwhile counts as done. What fails again stays open with one more retry. A replay
    counts attempts, so rerunning exactly this ``batch`` (numbers ascend) does nothing.
    """
    with store.writing():
        log = store.log()
        if not log.has("replay", batch):
            _replay(store, log, batch, clock, ids, config)


def _replay(store: Store, log: Log, batch: int, clock, ids: DataFrame | None, config: IngestConfig) -> None:
    new = store.begin(log)
    keys = None if ids is None else ids.select("failed_event_id").distinct()
    failed = store.read("failed_events", keys, log)
    eligible = replay_eligible(failed, M.error_categories(store.spark), ids).persist()
    try:
        feed = eligible.select(
            F.col("payload").alias("value"), F.col("original_topic").alias("topic"),
            F.col("original_partition").alias("partition"), F.col("original_offset").alias("offset"),
            F.col("first_failed_at").alias("timestamp"), F.col("failed_event_id").alias("key"))
        events = (parse_feed(feed, config.key_type, keep=("key",)).withColumn("received_at", F.lit(clock))
                  .withColumn("first_failed_at", F.lit(None).cast("timestamp")))
        fits = eligible.count() <= config.broadcast_rows
        shipments = stored_for(store, log, "shipments", events.select("shipment_id"), fits)
        history = store.stored_ids(events.select("event_id"), log, fits)
        outcomes = cut_lineage(outcome_stream(events, shipments, config.vocabulary, history, policy=config.policy))
        new.put({"outcomes": outcomes.withColumns({
            "parked": F.lit(False), "attempts": F.lit(1), "next_due_at": F.lit(None).cast("timestamp")})})
        written = new.rows("outcomes")

        # a payload that no longer decodes is a failure of unknown kind
        again = failures_of(outcomes, keep=("key",)).withColumn("error_category", F.when(
            F.col("error_category") == "MALFORMED_PAYLOAD", "UNKNOWN").otherwise(F.col("error_category")))
        # by the failed event's own id: an origin may be unknown
        attempts = eligible.select("failed_event_id").join(
            again.select(F.col("key").alias("failed_event_id"), "error_category", "error_type", "error_message",
                         "failed_at"), "failed_event_id", "left")
        publish(store, log, written, shipments, new, fits, replay_result(eligible, attempts))
        store.commit(new, "replay", batch)
    finally:
        eligible.unpersist()
