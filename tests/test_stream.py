import shutil
import time
from datetime import timedelta, timezone

import pytest

from helpers import F, T0, feed, shipments, table, uuid_of, wire
from waybill.operators.reports import attempt_counts, outcome_counts
from waybill.sources.feed import read_feed
from waybill.sources.store import IDS, Store
from waybill.streaming import IngestConfig, ingest, live_rates, register, replay, revise, start, tick

CLOCK = (T0 + timedelta(days=60)).replace(tzinfo=timezone.utc)
TABLES = {
    "tracking_events": ["event_id", "shipment_id", "normalized_event_type", "processing_status", "received_at"],
    "notifications": ["notification_id", "shipment_id", "source_event_id", "notification_type", "created_at"],
    "shipments": ["shipment_id", "current_status", "last_sequence_number", "version", "updated_at"],
    "failed_events": ["failed_event_id", "error_category", "status", "version", "retry_count", "first_failed_at",
                      "last_failed_at"],
    "dead_letters": ["value", "error_category", "original_offset"],
}


def messages():
    out = []
    codes = ["SP_CREATED", "SP_PICKUP", "SP_TRANSIT", "SP_DEPOT", "SP_OFD", "SP_ATTEMPT", "SP_DELIVERED", "SP_DELAY"]
    for i in range(40):
        out.append(wire(i, shipment=1 + i % 3, sequence=1 + (i * 7) % 20, code=codes[i % 8]))
        if i % 5 == 0:
            out.append(out[-1])
    out += ["not json", wire(90, code="SP_TELEPORTED"), wire(91, schemaVersion=99), wire(92, shipment=77),
            wire(90, code="SP_TELEPORTED"), None]
    return out


@pytest.fixture(scope="module")
def template(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("template") / "store"
    s = Store(spark, str(path)).create()
    put(s, shipments(spark, [uuid_of(i) for i in (1, 2, 3)]).coalesce(1))
    return path


def put(store, rows, table="shipments"):
    batch = store.begin()
    batch.put({table: rows})
    return store.commit(batch, "register", 0)


@pytest.fixture()
def fresh(spark, template, tmp_path):
    """Makes stores with three registered shipments."""
    def make(name="store"):
        shutil.copytree(template, tmp_path / name)
        return Store(spark, str(tmp_path / name))
    return make


@pytest.fixture()
def store(fresh):
    return fresh()


def contents(store):
    return {t: table(store.read(t), *c) for t, c in TABLES.items()}


def test_batches_equal_one_pass(spark, fresh):
    once, split = fresh("a"), fresh("b")
    now = IngestConfig(retries=0)
    everything = messages()
    ingest(feed(spark, everything), 0, once, now)
    for n, at in enumerate(range(0, len(everything), 27)):
        ingest(feed(spark, everything[at:at + 27], start=at), n, split, now)
    assert contents(once) == contents(split)
    counts = outcome_counts(once.read("outcomes")).first().asDict()
    assert counts["processed"] == counts["applied"] + counts["out_of_order"] + counts["duplicate"]
    assert counts["duplicate"] == 8 and counts["failed"] == 6 and counts["received"] == len(everything) - 1


def test_rerun_of_a_batch_changes_nothing(spark, store):
    mine = IngestConfig(retries=0, run="one")
    ingest(feed(spark, messages()), 0, store, mine)
    before, last = contents(store), store.log().last
    ingest(feed(spark, messages()), 0, store, mine)
    assert store.log().last == last and contents(store) == before
    # the same records under a new batch number are redeliveries
    ingest(feed(spark, messages()), 1, store, IngestConfig(retries=0))
    after = contents(store)
    for name in ("tracking_events", "notifications", "shipments"):
        assert after[name] == before[name]


def test_a_batch_without_marker_is_invisible_and_redone(spark, store, monkeypatch):
    before = contents(store)
    with monkeypatch.context() as broken:
        broken.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            ingest(feed(spark, messages()), 0, store, IngestConfig(retries=0))
    assert contents(store) == before
    ingest(feed(spark, messages()), 0, store, IngestConfig(retries=0))
    assert len(contents(store)["tracking_events"]) == 40


def test_a_dead_batch_stays_invisible_when_another_writer_commits(spark, fresh, monkeypatch):
    plain, hurt = fresh("a"), fresh("b")
    early = [wire(1, shipment=1, sequence=1, code="SP_CREATED"), wire(2, shipment=1, sequence=2, code="SP_PICKUP")]
    requests = spark.createDataFrame([(1, "r", "c", "N-1", "SWIFTPOST", None, T0)], REQUESTS)
    with monkeypatch.context() as broken:
        broken.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            ingest(feed(spark, early), 0, hurt)
    for s in (plain, hurt):
        register(s, requests, 1)
        assert s.read("tracking_events").count() == 0
        ingest(feed(spark, early), 0, s)
    assert contents(plain) == contents(hurt)
    assert hurt.read("shipments").where(F.col("shipment_id") == uuid_of(1)).first()["version"] == 2


def test_a_used_batch_number_drops_nothing(spark, store, tmp_path):
    ingest(feed(spark, [wire(1)]), 0, store, IngestConfig(retries=0))
    ingest(feed(spark, [wire(2), wire(3)], start=1), 0, store, IngestConfig(retries=0))
    assert store.read("tracking_events").count() == 3
    for n, checkpoint in ((4, "one"), (5, "two")):     # a new checkpoint counts from 0 again
        folder = str(tmp_path / f"feed-{n}")
        feed(spark, [wire(n)], start=n).coalesce(1).write.parquet(folder)
        start(read_feed(spark, folder, stream=True), store, str(tmp_path / checkpoint), IngestConfig(retries=0)).awaitTermination(120)
    assert store.read("tracking_events").count() == 5
    requests = [spark.createDataFrame([(1, "r", "c", number, "SWIFTPOST", None, T0)], REQUESTS) for number in ("N-1", "N-2")]
    for r in requests:
        register(store, r, 1)
    assert store.read("shipments").where(F.col("tracking_number").startswith("N-")).count() == 2


def test_batches_of_two_writers_both_stay(spark, store):
    one, two = store.begin(), store.begin()
    for n, batch in ((8, one), (9, two)):
        batch.put({"shipments": shipments(spark, [uuid_of(n)])})
    store.commit(one, "register", 1)
    assert store.read("shipments").count() == 4
    store.commit(two, "register", 2)
    assert store.read("shipments").count() == 5
    with pytest.raises(ValueError):                      # ids are found by their bucket
        Store(spark, store.path, id_buckets=3).log()


def test_a_batch_done_again_replaces_what_a_dead_one_left(spark, store, monkeypatch):
    mine, first = IngestConfig(retries=0, run="r"), [wire(n) for n in range(6)]
    with monkeypatch.context() as broken:
        broken.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            ingest(feed(spark, first), 0, store, mine)
    ingest(feed(spark, first[:2]), 0, store, mine)       # the same batch, read anew with fewer records
    assert store.read("tracking_events").count() == 2 and store.read("outcomes").count() == 2


def test_arrival_is_the_offset_not_the_timestamp(spark, fresh):
    def record(n, offset, at, code, sequence):
        return feed(spark, [wire(n, sequence=sequence, code=code)], start=offset).withColumn(
            "timestamp", F.lit(T0 + timedelta(days=30, seconds=at)))

    first, second = record(1, 0, 10, "SP_DELIVERED", 1), record(2, 1, 5, "SP_TRANSIT", 2)
    once, split = fresh("a"), fresh("b")
    ingest(first.union(second), 0, once)
    ingest(first, 0, split)
    ingest(second, 1, split)
    assert contents(once) == contents(split)
    assert table(once.read("tracking_events"), "event_id", "processing_status") == [
        (uuid_of(1), "APPLIED"), (uuid_of(2), "SUPERSEDED")]


def test_the_same_record_twice_is_stored_once(spark, store):
    one = feed(spark, [wire(1)])
    ingest(one.union(one), 0, store)
    assert store.read("tracking_events").count() == 1
    waiting = feed(spark, [wire(2, shipment=9)], start=1)
    ingest(waiting, 1, store)
    ingest(waiting, 2, store)                            # read again while it is parked
    assert store.parked().count() == 1
    put(store, shipments(spark, [uuid_of(9)]))
    ingest(feed(spark, [wire(3)], start=2), 3, store)
    assert store.read("tracking_events").count() == 3


def test_structured_streaming_equals_batch(spark, fresh, tmp_path):
    once, streamed = fresh("a"), fresh("b")
    everything = messages()
    ingest(feed(spark, everything), 0, once, IngestConfig(retries=0))
    for at in range(0, len(everything), 30):
        feed(spark, everything[at:at + 30], start=at).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    source = read_feed(spark, str(tmp_path / "feed"), stream=True)
    query = start(source, streamed, str(tmp_path / "checkpoint"), IngestConfig(retries=0))
    query.awaitTermination(120)
    assert query.exception() is None
    assert contents(once) == contents(streamed)


def test_parked_events_wait_for_their_shipment(spark, store):
    early = [wire(1, shipment=9, sequence=1, code="SP_CREATED"), wire(2, shipment=9, sequence=2, code="SP_PICKUP")]
    ingest(feed(spark, early), 0, store)
    assert store.parked().count() == 2 and store.read("failed_events").count() == 0
    put(store, shipments(spark, [uuid_of(9)]))
    ingest(feed(spark, [wire(3, shipment=9, sequence=3)], start=2), 1, store)
    assert store.parked().count() == 0
    assert table(store.read("tracking_events").where(F.col("shipment_id") == uuid_of(9)), "event_id",
                 "processing_status") == [(uuid_of(n), "APPLIED") for n in (1, 2, 3)]
    assert store.read("shipments").where(F.col("shipment_id") == uuid_of(9)).first()["version"] == 3


def test_parked_events_fail_when_retries_are_used_up(spark, store):
    ingest(feed(spark, [wire(1, shipment=9)]), 0, store)
    ingest(feed(spark, [wire(2)], start=4), 1, store)         # 4 s later: one attempt is left
    assert store.parked().count() == 1
    ingest(feed(spark, [wire(3)], start=5), 2, store)         # 5 s: the last one
    assert store.parked().count() == 0
    assert table(store.read("failed_events"), "event_id", "error_category") == [(uuid_of(1), "SHIPMENT_NOT_FOUND")]
    assert store.read("dead_letters").count() == 1


def test_parked_events_survive_other_commits_and_idle_batches(spark, store):
    ingest(feed(spark, [wire(1, shipment=9)]), 0, store)
    assert store.merge_small(fan=2) == 3
    last = store.log().last
    ingest(feed(spark, []), 1, store, clock=T0 + timedelta(days=30, milliseconds=100))
    assert store.log().last == last and store.parked().count() == 1     # nothing is due yet
    ingest(feed(spark, []), 2, store, clock=CLOCK)
    assert store.parked().count() == 0 and store.read("failed_events").count() == 1


def test_the_delay_queue_counts_tries(spark, store):
    at = T0 + timedelta(days=30)
    waiting = lambda: table(store.parked(), "event_id", "attempts", "next_due_at")
    ingest(feed(spark, [wire(1, shipment=9), wire(2, shipment=8)]), 0, store)          # received at 0 s and 1 s
    # the batch's time is 1 s: two retries of the first one have passed, none of the second
    assert waiting() == [(uuid_of(1), 3, at + timedelta(seconds=1.4)), (uuid_of(2), 1, at + timedelta(seconds=1.2))]
    tick(store, clock=at + timedelta(seconds=1.1))
    assert [w[1] for w in waiting()] == [3, 1]                                           # not due
    tick(store, clock=at + timedelta(seconds=1.2))
    assert [w[1] for w in waiting()] == [3, 2]
    put(store, shipments(spark, [uuid_of(8)]))
    tick(store, clock=at + timedelta(seconds=4))
    assert waiting() == [(uuid_of(1), 5, at + timedelta(seconds=5))]
    tick(store, clock=at + timedelta(seconds=5))
    assert waiting() == [] and store.read("dead_letters").count() == 1
    tries = table(store.read("outcomes"), "event_id", "outcome", "attempts")
    assert tries == [(uuid_of(1), "SHIPMENT_NOT_FOUND", 6), (uuid_of(2), "APPLIED", 5)]
    counts = attempt_counts(store.read("outcomes")).first()
    assert counts.asDict() == {"received": 11, "processed": 1, "failed": 10, "dead_lettered": 1}


def test_retries_end_without_further_input(spark, store, tmp_path):
    """A stream that gets one record and then nothing: its clock fails the record by itself."""
    feed(spark, [wire(1, shipment=9)]).coalesce(1).write.parquet(str(tmp_path / "feed"))
    query = start(read_feed(spark, str(tmp_path / "feed"), stream=True), store, str(tmp_path / "checkpoint"),
                  IngestConfig(ticks=True), interval="1 second")
    try:
        end = time.time() + 240
        while not store.read("dead_letters").count() and time.time() < end:
            assert query.exception() is None
            time.sleep(1)
    finally:
        query.stop()
    assert store.parked().count() == 0
    assert table(store.read("outcomes"), "outcome", "attempts") == [("SHIPMENT_NOT_FOUND", 6)]


def test_small_batches_are_merged(spark, store):
    """Many batches end in few folders and files; every read stays the same, and so does what is known of runs."""
    ingest(feed(spark, messages()), 7, store, IngestConfig(retries=0, run="r", merge_every=0))
    for n in range(100, 130):
        b = store.begin()
        b.put({"shipments": shipments(spark, [uuid_of(n % 9)], version=n).coalesce(1),
               IDS: spark.createDataFrame([(uuid_of(n),)], "event_id string")})
        store.commit(b, "test", n)
    before, ids = contents(store), spark.createDataFrame([(uuid_of(n),) for n in range(200)], "event_id string")
    known = table(store.stored_ids(ids), "event_id")
    assert len(known) == 70
    merged = 0
    while joined := store.merge_small(fan=4):
        merged += joined
    assert merged > 30 and contents(store) == before and len(store.log().markers) < 4
    assert table(store.stored_ids(ids), "event_id") == table(store.stored_ids(ids, broadcast=False), "event_id") == known
    ingest(feed(spark, messages()), 7, store, IngestConfig(retries=0, run="r"))         # still known as done
    assert contents(store) == before
    store.drop_merged()
    store.drop_merged()
    assert contents(store) == before
    files = [f.split("/rows/")[1] for f in store.spark.read.parquet(f"{store.path}/rows").inputFiles()]
    assert len({f.split("/")[0] for f in files}) < 4 and sum("kind=event_ids" not in f for f in files) < 30


def test_look_ups_read_only_the_buckets_of_their_ids(spark, tmp_path):
    store = Store(spark, str(tmp_path / "ids"), id_buckets=16).create()
    for n in range(4):
        b = store.begin()
        b.put({IDS: spark.range(n * 500, n * 500 + 500).select(F.col("id").cast("string").alias("event_id"))})
        store.commit(b, "test", n)
    assert store.merge_small(fan=4)
    keys = spark.createDataFrame([("7",), ("1999",), ("none",)], "event_id string")
    found = store.stored_ids(keys)
    assert table(found, "event_id") == [("1999",), ("7",)]
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString().lower()
    read = {r["bucket"] for r in keys.select(store.bucket_of(F.col("event_id")).alias("bucket")).collect()}
    scans = [line for line in plan.toString().splitlines() if "FileScan" in line]      # of the final and the first plan
    assert scans and all("dynamicpruning" in line and "bucket" in line for line in scans) and len(read) <= 3
    everything = store.stored_ids(spark.range(3000).select(F.col("id").cast("string").alias("event_id")), broadcast=False)
    assert everything.count() == 2000


def test_the_tenth_batch_is_as_fast_as_the_first(spark, store):
    """Fifty times the history of stored ids costs a batch little."""
    def stored(low, high):
        b = store.begin()
        b.put({IDS: spark.range(low, high).select(F.concat(F.lit("old-"), F.col("id").cast("string")).alias("event_id"))})
        store.commit(b, "test", low)

    def seconds(n):
        begin = time.perf_counter()
        ingest(feed(spark, [wire(n * 10 + i) for i in range(10)], start=n * 10), n, store, IngestConfig(merge_every=0))
        return time.perf_counter() - begin

    stored(0, 20_000)
    seconds(0)                                            # compiled and warm
    first = min(seconds(n) for n in (1, 2, 3))
    stored(20_000, 1_000_000)
    tenth = min(seconds(n) for n in (4, 5, 6))
    assert tenth <= 1.3 * first + 1


def test_ticks_move_the_feeds_time(spark, store, monkeypatch):
    """Without records the feed's time goes on with the wall clock, from the last batch."""
    from waybill.sources import store as module
    ingest(feed(spark, [wire(1, shipment=9)]), 0, store)
    now = time.time()
    monkeypatch.setattr(module.time, "time", lambda: now + 3)
    tick(store)
    assert table(store.parked(), "attempts")[0][0] >= 5
    monkeypatch.setattr(module.time, "time", lambda: now + 60)
    tick(store)
    assert store.parked().count() == 0 and store.read("failed_events").count() == 1


def test_replay(spark, store):
    now = IngestConfig(retries=0)
    ingest(feed(spark, [wire(1, shipment=9), wire(2, carrier="NORDEX"), wire(3, code="SP_TELEPORTED"),
                        wire(4, shipment=8)]), 0, store, now)
    put(store, shipments(spark, [uuid_of(9)]))
    replay(store, 0, CLOCK)
    rows = {r["event_id"]: r for r in store.read("failed_events").collect()}
    assert rows[uuid_of(1)]["status"] == "RESOLVED" and rows[uuid_of(1)]["retry_count"] == 0
    # no replay helps a carrier mismatch or an unknown code
    assert rows[uuid_of(2)]["error_category"] == "CARRIER_MISMATCH" and rows[uuid_of(2)]["version"] == 0
    assert rows[uuid_of(3)]["status"] == "FAILED" and rows[uuid_of(3)]["retry_count"] == 0
    assert rows[uuid_of(4)]["status"] == "FAILED" and rows[uuid_of(4)]["retry_count"] == 1
    assert store.read("tracking_events").count() == 1
    replay(store, 1, CLOCK)
    rows = {r["event_id"]: r for r in store.read("failed_events").collect()}
    assert rows[uuid_of(1)]["version"] == 1 and rows[uuid_of(4)]["retry_count"] == 2
    assert store.read("tracking_events").count() == 1


def test_replay_of_what_was_stored_meanwhile_is_a_success(spark, store):
    now = IngestConfig(retries=0)
    ingest(feed(spark, [wire(1, shipment=9)]), 0, store, now)
    put(store, shipments(spark, [uuid_of(9)]))
    ingest(feed(spark, [wire(1, shipment=9)], start=1), 1, store, now)
    replay(store, 0, CLOCK)
    assert store.read("failed_events").first()["status"] == "RESOLVED"
    assert store.read("tracking_events").count() == 1 and store.read("notifications").count() == 0


def test_replay_of_chosen_ids_with_an_unknown_origin(spark, store):
    ingest(feed(spark, [wire(1, shipment=9), wire(2, shipment=8)]), 0, store, IngestConfig(retries=0))
    put(store, store.read("failed_events").withColumns(
        {c: F.lit(None) for c in ("original_topic", "original_partition", "original_offset")}), "failed_events")
    failed = store.read("failed_events")
    replay(store, 0, CLOCK, failed.where(F.col("event_id") == uuid_of(1)).select("failed_event_id"))
    assert table(store.read("failed_events"), "event_id", "status", "retry_count") == [
        (uuid_of(1), "FAILED", 1), (uuid_of(2), "FAILED", 0)]


REQUESTS = ("request_id long, retailer_id string, customer_id string, tracking_number string, carrier_code string, "
            "estimated_delivery_date date, requested_at timestamp")


def test_register_and_revise(spark, store):
    requests = spark.createDataFrame(
        [(1, "r", "c", "N-1", "SWIFTPOST", None, T0), (2, "r", "c", "N-1", "SWIFTPOST", None, T0),
         (3, "r", "c", "N-1", "PACIFICA", None, T0)], REQUESTS)
    register(store, requests, 1)
    register(store, requests, 1)
    register(store, requests, 2)
    made = store.read("shipments").where(F.col("tracking_number") == "N-1")
    assert made.count() == 2
    sid = made.where(F.col("carrier_code") == "SWIFTPOST").first()["shipment_id"]
    ingest(feed(spark, [wire(1, shipmentId=sid)]), 0, store)
    assert store.read("shipments").where(F.col("shipment_id") == sid).first()["current_status"] == "IN_TRANSIT"
    revisions = spark.createDataFrame([(1, sid, T0.date(), T0 + timedelta(days=99))],
                                      "revision_id long, shipment_id string, estimated_delivery_date date, revised_at timestamp")
    revise(store, revisions, 1)
    row = store.read("shipments").where(F.col("shipment_id") == sid).first()
    assert row["estimated_delivery_date"] == T0.date() and row["current_status"] == "IN_TRANSIT"
    before = contents(store)
    assert store.merge_small(fan=2)
    assert contents(store) == before


def test_live_rates_on_a_stream(spark, store, tmp_path):
    ingest(feed(spark, messages()), 0, store, IngestConfig(retries=0))
    stream = spark.readStream.schema(store.schemas["outcomes"]).parquet(
        f"{store.path}/rows/batch={store.log().markers[-1]['name']}/kind=outcomes")
    query = (live_rates(stream, "10 seconds").writeStream.outputMode("complete").format("memory")
             .queryName("live").trigger(availableNow=True).start())
    query.awaitTermination(120)
    live = spark.table("live").agg(F.sum("received"), F.sum("duplicate")).first()
    assert tuple(live) == (len(messages()) - 1, 8)
