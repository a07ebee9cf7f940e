"""One micro-batch of the feed into the tables; the same function serves batch and stream."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import model as M
from ..operators.failures import dead_letters, failed_events_upsert
from ..operators.notify import notifications_new
from ..operators.outcome import failures_of
from ..operators import retries
from ..operators.skew import DEFAULT, SkewPolicy
from ..operators.state import shipments_upsert, state_deltas
from ..plans.pipeline import history_of, outcome_stream
from ..sources.feed import parse_feed
from ..sources.sinks import publish_dead_letters
from ..sources.store import FEED, IDS, Batch, Log, Store


@dataclass(frozen=True)
class IngestConfig:
    source: str = "feed"
    # identity of the run that numbers the batches (a stream's: of its checkpoint); without one, a batch
    # that is delivered again is read again, and its events are redeliveries
    run: str | None = None
    key_type: str = "string"
    # automatic retries of events whose shipment is not registered yet
    retries: int = M.RETRY_LIMIT
    retry_initial_ms: int = M.RETRY_INITIAL_MS
    retry_multiplier: float = M.RETRY_MULTIPLIER
    retry_max_ms: int = M.RETRY_MAX_MS
    # a batch of at most this many rows has its keys broadcast to the stored tables
    broadcast_rows: int = 1_000_000
    policy: SkewPolicy = DEFAULT
    vocabulary: DataFrame | None = None      # the built-in one
    # brokers and topic that get a copy of the dead letters, after their rows are written
    dead_letter_brokers: str | None = None
    dead_letter_topic: str = "carrier-tracking-events-dlt"

    # small batches are joined when this many of a size are there (0: never)
    merge_every: int = 16
    # a running stream has batches while no records come, one per trigger, that look at parked events
    ticks: bool = False

    @property
    def due_ms(self) -> list[int]:
        """When each retry is due, after the first failure."""
        return retries.due_ms(retries.waits_ms(
            self.retry_initial_ms, self.retry_multiplier, self.retry_max_ms, self.retries))


def ingest(feed: DataFrame, batch_id: int, store: Store, config: IngestConfig = IngestConfig(),
           clock=None) -> None:
    """Processes one batch of the feed and commits it.

    A batch that this very run has committed is skipped; one that died before its marker left nothing
    that anyone reads. Any other redelivery is harmless, as stored events are known by their ids.

    Events of a shipment that is not registered are parked and join the next batches in their
    arrival order. They leave when the shipment exists (all of them at once), or fail when their
    automatic retries are used up. Each carries the number of its tries and the time of the next.
    Time is the feed's own: ``clock`` (a datetime), or the latest reception in the batch. A batch without
    records moves the feed's time on by the time since the last one was written, and tries what is due.
    """
    source = FEED + config.source + (f":{config.run}" if config.run else "")
    with store.writing():
        log = store.log()
        if config.run and log.has(source, batch_id):
            return
        events = (parse_feed(feed, config.key_type)
                  .withColumns({"first_failed_at": F.lit(None).cast("timestamp"),
                                "attempts": F.lit(None).cast("int")}).persist())
        try:
            _ingest(events, batch_id, source, store, log, config, clock)
        finally:
            events.unpersist()
        if config.merge_every:
            store.merge_small(config.merge_every)


def tick(store: Store, config: IngestConfig = IngestConfig(), clock=None) -> None:
    """A batch without records: tries the parked events that are due, and fails those that have no try left."""
    ingest(store.spark.createDataFrame([], M.FEED_SCHEMA), -1, store, replace(config, run=None), clock)


def _ingest(events: DataFrame, batch_id: int, source: str, store: Store, log: Log, config: IngestConfig, clock) -> None:
    rows, begin, end = events.agg(F.count("*"), F.min(F.unix_micros("received_at")),
                                  F.max(F.unix_micros("received_at"))).first()
    now = _micros(clock) if clock is not None else end if rows else log.clock()
    if now is None:
        return                              # nothing came yet
    parked = store.parked(log) if config.retries and log.feed_commit is not None else None
    if rows == 0:
        due = None if parked is None else parked.agg(F.min(F.unix_micros("next_due_at"))).first()[0]
        if due is None or due > now:
            return                          # nothing came and nothing is due
    begin = F.timestamp_micros(F.lit(begin if rows else now))
    batch = store.begin(log, f"{source}-{batch_id}" if config.run else None)
    everything = events
    if parked is not None:
        rows += parked.count()
        # a parked record that is read again is the same record
        record = ["topic", "partition", "offset"]
        everything = (events.join(parked.select(*record), record, "left_anti").select(*events.columns)
                      .unionByName(_released(parked, begin, events)))
    _process(everything, rows, F.timestamp_micros(F.lit(now)), batch, store, log, config)
    if config.dead_letter_brokers:
        # before the marker: a batch that dies here is redone and sends again, none gets lost
        publish_dead_letters(batch.rows("dead_letters"), config.dead_letter_brokers, config.dead_letter_topic)
    store.commit(batch, source, batch_id, now)


def _micros(moment) -> int:
    return round(moment.timestamp() * 1_000_000)


def _released(parked: DataFrame, begin: Column, events: DataFrame) -> DataFrame:
    """Parked rows as events again. An attempt that succeeds now is received now: just before the
    batch's own events, so reception still follows arrival."""
    return parked.select(*[
        begin.alias(c) if c == "received_at"
        else F.lit(False).alias(c) if c in ("payload_missing", "malformed")
        else F.col(c) for c in events.columns])


def stored_for(store: Store, log: Log, table: str, keys: DataFrame, broadcast: bool) -> DataFrame:
    """The stored rows with one of ``keys``. ``broadcast`` says the keys were counted and fit: then
    the big table is filtered where it is read and only what is left gets shuffled."""
    keys = keys.distinct()
    return store.read(table, F.broadcast(keys) if broadcast else keys, log)


def _process(events: DataFrame, rows: int, now: Column, batch: Batch, store: Store, log: Log,
             config: IngestConfig) -> None:
    fits = rows <= config.broadcast_rows
    known = events.where(F.col("event_id").isNotNull()).select("event_id")
    touched = events.where(F.col("shipment_id").isNotNull()).select("shipment_id")
    shipments = stored_for(store, log, "shipments", touched, fits)
    history = store.stored_ids(known, log, fits)

    outcomes = outcome_stream(events, shipments, config.vocabulary, history, policy=config.policy)
    first = F.coalesce("first_failed_at", "received_at")
    missing = F.lit(config.retries > 0) & (F.col("outcome") == "SHIPMENT_NOT_FOUND")
    waits = missing | F.col("first_failed_at").isNotNull()       # it has been in the queue, or enters it
    passed = F.when(waits, retries.retries_passed(first, now, config.due_ms)).otherwise(F.lit(0))
    parked = missing & (passed < len(config.due_ms))
    staged = outcomes.withColumns({
        "parked": parked, "first_failed_at": first,
        "attempts": retries.tries(passed, F.when(~missing, F.col("attempts"))),
        "next_due_at": F.when(parked, retries.next_due(first, passed, config.due_ms)),
        # failing is final now; a try's time is the batch's
        "received_at": F.when(missing & ~parked, now).otherwise(F.col("received_at"))})
    # written once, then every table is derived from the written rows
    batch.put({"outcomes": staged})
    publish(store, log, batch.rows("outcomes").where(~F.col("parked")), shipments, batch, fits)


def publish(store: Store, log: Log, outcomes: DataFrame, shipments: DataFrame, batch: Batch, fits: bool,
            failed_delta: DataFrame | None = None) -> None:
    """History, ids, notifications, state, failed events and dead letters of a batch, by one write.

    Existing notifications need no look-up: an event id that made one is in history, so its
    redelivery is no applied event.
    """
    history, deltas = history_of(outcomes), state_deltas(outcomes)
    tables = {
        "tracking_events": history, IDS: history.select("event_id"),
        "notifications": notifications_new(outcomes, M.notification_rules(store.spark)),
        "shipments": shipments_upsert(shipments.join(deltas.select("shipment_id"), "shipment_id", "left_semi"), deltas)}
    if failed_delta is None:
        failures = failures_of(outcomes)
        ids = failures.where(F.col("event_id").isNotNull()).select("event_id")
        failed_delta = failed_events_upsert(stored_for(store, log, "failed_events", ids, fits), failures)
        tables["dead_letters"] = dead_letters(failures)
    batch.put({**tables, "failed_events": failed_delta})


def start(feed: DataFrame, store: Store, checkpoint: str, config: IngestConfig = IngestConfig(), *,
          interval: str | None = None) -> StreamingQuery:
    """Runs ``ingest`` on a streaming feed; without ``interval`` until what is there is processed.

    With ``ticks`` a clock runs beside the feed, whose rows are dropped: it only makes batches
    happen while no records come, so that retries end without further input."""
    def run(df: DataFrame, batch_id: int) -> None:
        # the id in the checkpoint: a new checkpoint is a new run, so its batches are never taken for old ones
        known = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest(df, batch_id, store, replace(config, run=known or config.run))

    if config.ticks and interval:
        clock = store.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        nothing = clock.where(F.col("value") < 0)
        feed = feed.unionByName(nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in feed.schema]))
    writer = feed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
