import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import F, M, T0, event, events, feed, shipments, table, wire
from waybill.operators import failures, fold, lookup, notify, pages, rates, reports
from waybill.operators.skew import SkewPolicy, find_heavy
from waybill.operators.validate import validate_events
from waybill.plans.pipeline import outcome_stream
from waybill.sources import dead_letter_records, flatten_batches, parse_feed

EAGER = SkewPolicy(heavy_rows=3, sample_every=1, chunk_rows=2)   # nearly everything counts as heavy
CODE = {s: c for carrier, c, s in M.VOCABULARY if carrier == "SWIFTPOST"}


# --- the ordering rule ---------------------------------------------------------------------------

# (sequence, event hour, received second, status), applied?
CASES = {
    "first event always wins": [((1, 1, 0, "PICKED_UP"), True)],
    "higher sequence wins": [((1, 1, 0, "PICKED_UP"), True), ((2, 2, 1, "IN_TRANSIT"), True)],
    "lower sequence loses": [((5, 5, 0, "IN_TRANSIT"), True), ((3, 9, 1, "PICKED_UP"), False)],
    "sequence outranks time": [((1, 9, 0, "PICKED_UP"), True), ((2, 1, 1, "IN_TRANSIT"), True)],
    "equal sequence, later time wins": [((1, 1, 0, "PICKED_UP"), True), ((1, 2, 1, "IN_TRANSIT"), True)],
    "equal sequence, earlier time loses": [((1, 2, 0, "PICKED_UP"), True), ((1, 1, 1, "IN_TRANSIT"), False)],
    "all equal, later reception wins": [((1, 1, 0, "DELAYED"), True), ((1, 1, 5, "IN_TRANSIT"), True)],
    "all equal, earlier reception loses": [((1, 1, 5, "DELAYED"), True), ((1, 1, 0, "IN_TRANSIT"), False)],
    "a tie in everything wins": [((1, 1, 0, "DELAYED"), True), ((1, 1, 0, "IN_TRANSIT"), True)],
    "backwards in status is fine": [((1, 1, 0, "OUT_FOR_DELIVERY"), True), ((2, 2, 1, "ARRIVED_AT_FACILITY"), True)],
    "delivered is final": [((1, 1, 0, "DELIVERED"), True), ((2, 2, 1, "IN_TRANSIT"), False),
                           ((3, 3, 2, "DELIVERED"), False)],
    "a late delivery does not freeze": [((5, 5, 0, "IN_TRANSIT"), True), ((2, 2, 1, "DELIVERED"), False),
                                        ((6, 6, 2, "DELAYED"), True)],
    "reversed journey": [((3, 3, 0, "DELIVERED"), True), ((2, 2, 1, "IN_TRANSIT"), False),
                         ((1, 1, 2, "PICKED_UP"), False)],
}


def rows_of(journeys):
    """journeys: name -> [(sequence, hour, received, status)] in arrival order."""
    rows = []
    for name, steps in journeys.items():
        for i, (sequence, hour, received, status) in enumerate(steps):
            rows.append((name, i, sequence, T0 + timedelta(hours=hour), T0 + timedelta(days=9, seconds=received), status))
    return rows


def stored(spark, journeys):
    return spark.createDataFrame(rows_of(journeys), "shipment_id string, arrival long, sequence_number long, "
                                 "event_time timestamp, received_at timestamp, normalized_event_type string")


def sequential(steps, held=None, final=False):
    """The rule, one event at a time."""
    best, delivered, out = held, final, []
    for sequence, hour, received, status in steps:
        wins = not delivered and (best is None or (sequence, hour, received) >= best)
        if wins:
            best, delivered = (sequence, hour, received), status == "DELIVERED"
        out.append(wins)
    return out


def applied(df):
    out = {}
    for name, _, flag in sorted((r["shipment_id"], r["arrival"], r["applied"]) for r in df.collect()):
        out.setdefault(name, []).append(flag)
    return out


@pytest.mark.parametrize("policy", [SkewPolicy(), EAGER], ids=["plain", "heavy"])
def test_ordering_cases(spark, policy):
    journeys = {name: [step for step, _ in steps] for name, steps in CASES.items()}
    df = stored(spark, journeys)
    heavy = find_heavy(df, ["shipment_id"], policy).get("shipment_id")
    got = applied(fold.ordering_fold(df, heavy=heavy))
    assert got == {name: [flag for _, flag in steps] for name, steps in CASES.items()}


def test_held_state_seeds_the_fold(spark):
    journey = [(4, 4, 0, "IN_TRANSIT"), (5, 5, 1, "DELIVERED")]
    df = stored(spark, {"fresh": journey, "ahead": journey, "done": journey, "unfilled": [(4, 4, 0, "IN_TRANSIT")]})
    state = (shipments(spark, ["fresh"])
             .union(shipments(spark, ["ahead"], last_sequence_number=5, last_event_time=T0 + timedelta(hours=4),
                              last_received_at=T0, current_status="DELAYED"))
             .union(shipments(spark, ["done"], current_status="DELIVERED", last_sequence_number=1,
                              last_event_time=T0, last_received_at=T0))
             # reception time not filled in: the incoming event wins the tie
             .union(shipments(spark, ["unfilled"], last_sequence_number=4, last_event_time=T0 + timedelta(hours=4))))
    assert applied(fold.ordering_fold(df, state)) == {
        "fresh": [True, True], "ahead": [False, True], "done": [False, False], "unfilled": [True]}


STEP = st.tuples(st.integers(1, 4), st.integers(0, 2), st.integers(0, 3), st.sampled_from(
    ["IN_TRANSIT", "DELAYED", "PICKED_UP", "DELIVERED"]))


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(STEP, min_size=1, max_size=25), min_size=30, max_size=60))
def test_windows_equal_the_sequential_fold(spark, journeys):
    named = {f"j{i:03d}": steps for i, steps in enumerate(journeys)}
    want = {name: sequential(steps) for name, steps in named.items()}
    df = stored(spark, named)
    assert applied(fold.ordering_fold(df)) == want
    heavy = find_heavy(df, ["shipment_id"], EAGER).get("shipment_id")
    folded = fold.ordering_fold(df, heavy=heavy)
    assert applied(folded) == want
    plain = table(fold.applied_timeline(folded, heavy=None), "shipment_id", "arrival", "status_before", "status_after")
    assert table(fold.applied_timeline(folded, heavy=heavy),
                 "shipment_id", "arrival", "status_before", "status_after") == plain


# --- redeliveries and skew -----------------------------------------------------------------------

def test_one_id_and_one_shipment_with_most_rows(spark):
    pick = random.Random(3)
    rows = []
    for n in range(400):
        crowd = n % 3 == 0
        rows.append(event(n, event_id="hot" if n % 4 == 0 else None if n % 11 == 0 else f"e{pick.randrange(120)}",
                          shipment_id="s1" if crowd else f"s{pick.randrange(2, 40)}",
                          sequence_number=pick.randrange(1, 30), carrier_code="SWIFTPOST" if n % 8 else "PACIFICA",
                          event_type=pick.choice(["SP_TRANSIT", "SP_DELAY", "SP_OFD", "SP_DELIVERED"])))
    df = events(spark, rows)
    parcels = shipments(spark, [f"s{i}" for i in range(1, 35)])
    history = spark.createDataFrame([("e5",), ("e6",)], "event_id string")
    columns = ["arrival", "event_id", "outcome"]
    plain = table(outcome_stream(df, parcels, M.vocabulary(spark), history).na.fill("-"), *columns)
    for policy in (EAGER, SkewPolicy(heavy_rows=50, sample_every=1, chunk_rows=9)):
        assert table(outcome_stream(df, parcels, M.vocabulary(spark), history, policy=policy).na.fill("-"),
                     *columns) == plain
    known = outcome_stream(df, parcels, M.vocabulary(spark),
                           history.union(spark.createDataFrame([("hot",)], "event_id string")), policy=EAGER)
    assert {r["outcome"] for r in known.where("event_id = 'hot' AND violation IS NULL").collect()} == {"DUPLICATE"}


def test_precedence(spark):
    rows = [
        event(1, event_id="a"), event(2, event_id="a", shipment_id="none"),          # stored, then known
        event(3, event_id="a", schema_version=9),                                    # but invalid comes first
        event(4, event_id="b", shipment_id="none"), event(5, event_id="b"),          # a failure stores no id
        event(6, carrier_code="NORDEX", event_type="X"), event(7, event_type="SP_TELEPORTED"),
        event(8, shipment_id="n1", carrier_code="NORDEX"), event(9, shipment_id="s2", event_id="a"),
    ]
    parcels = shipments(spark, ["s1", "s2"]).union(shipments(spark, ["n1"], carrier_code="NORDEX"))
    got = outcome_stream(events(spark, rows), parcels)
    assert [o for _, o in table(got, "arrival", "outcome")] == [
        "APPLIED", "DUPLICATE", "VALIDATION", "SHIPMENT_NOT_FOUND", "APPLIED", "CARRIER_MISMATCH",
        "UNKNOWN_EVENT_TYPE", "UNSUPPORTED_CARRIER", "DUPLICATE"]


def test_scenarios(spark):
    """A full journey stores 8 and notifies 3; repeats and shuffles change neither history nor end."""
    journey = ["SP_CREATED", "SP_PICKUP", "SP_TRANSIT", "SP_DEPOT", "SP_TRANSIT", "SP_DEPOT", "SP_OFD", "SP_DELIVERED"]
    plans = {"s1": list(range(8)), "s2": [i for n in range(8) for i in ([n, n] if n % 2 == 0 else [n])],
             "s3": [0, 5, 3, 1, 6, 2, 4, 7]}
    rows, at = [], 0
    for parcel, order in plans.items():
        for i in order:
            rows.append(event(at, event_id=f"{parcel}-{i}", shipment_id=parcel, sequence_number=i + 1, event_type=journey[i]))
            at += 1
    got = outcome_stream(events(spark, rows), shipments(spark, plans), M.vocabulary(spark))
    counted = {(s, o): n for s, o, n in table(got.groupBy("shipment_id", "outcome").count(), "shipment_id", "outcome", "count")}
    assert counted == {("s1", "APPLIED"): 8, ("s2", "APPLIED"): 8, ("s2", "DUPLICATE"): 4,
                       ("s3", "APPLIED"): 4, ("s3", "SUPERSEDED"): 4}
    made = notify.notifications_new(got, M.notification_rules(spark))
    assert table(made.groupBy("shipment_id").count(), "shipment_id", "count") == [("s1", 3), ("s2", 3), ("s3", 2)]


# --- lookups, validation, decoding ---------------------------------------------------------------

def test_every_code_in_any_case_and_space(spark):
    rows, want = [], []
    for n, (carrier, code, status) in enumerate(M.VOCABULARY):
        other = "PACIFICA" if carrier == "SWIFTPOST" else "SWIFTPOST"
        rows += [event(3 * n, carrier_code=carrier, event_type=f"\t {code.lower()} "),
                 event(3 * n + 1, carrier_code=other, event_type=code),
                 event(3 * n + 2, carrier_code="METROLINK", event_type=code)]
        want += [(3 * n, True, status), (3 * n + 1, True, None), (3 * n + 2, False, None)]
    for vocab in (None, M.vocabulary(spark)):
        got = lookup.normalize_events(events(spark, rows), vocab)
        assert table(got, "arrival", "carrier_supported", "normalized_event_type") == want


def test_a_code_declared_twice_is_an_error(spark):
    twice = M.vocabulary(spark).union(M.vocabulary(spark).limit(1))
    assert lookup.vocabulary_conflicts(twice).count() == 1
    with pytest.raises(Exception, match="(?i)duplicat"):
        lookup.normalize_events(events(spark, [event(1)]), twice).collect()


def test_validation_messages(spark):
    emoji = "\U0001F600"
    rows = [event(1), event(2, location=None, description=None), event(3, schema_version=None),
            event(4, tracking_number="\x01 ", correlation_id=None, sequence_number=0),
            event(5, tracking_number=emoji * 64), event(6, tracking_number=emoji * 65),
            event(7, schema_version=99, event_id=None)]
    got = dict(table(validate_events(events(spark, rows)), "arrival", "violation"))
    assert got == {
        1: None, 2: None, 3: "Unsupported schema version null; this service understands version 1",
        4: "Event failed validation: correlationId must not be blank, sequenceNumber must be greater than 0, "
           "trackingNumber must not be blank",
        5: None, 6: "Event failed validation: trackingNumber size must be between 0 and 128",
        7: "Unsupported schema version 99; this service understands version 1"}


def test_decoding(spark):
    good = wire(1)
    values = {
        "good": good, "extra field": good[:-1] + ', "more": {"x": 1}}', "number in quotes": wire(1, sequenceNumber="7"),
        "optional left out": good.replace('"location": "Rivermouth", ', ""), "nanoseconds": wire(1, eventTime="2026-08-01T10:00:00.123456789Z"),
        "missing": None, "null": " null ", "not json": "not json at all", "empty": "", "array": f"[{good}]",
        "cut": good[:-5], "word for number": wire(1, sequenceNumber="seven"), "bad id": wire(1, eventId="abc"),
        "unknown carrier": wire(1, carrier="ACME"), "bad time": wire(1, eventTime="yesterday"), "date": wire(1, eventTime="2026-08-01"),
    }
    got = parse_feed(feed(spark, list(values.values()))).orderBy("offset").collect()
    kinds = {name: "missing" if r["payload_missing"] else "malformed" if r["malformed"] else "decoded"
             for name, r in zip(values, got)}
    assert [n for n, k in kinds.items() if k == "decoded"] == list(values)[:5]
    assert [n for n, k in kinds.items() if k == "missing"] == ["missing", "null"]
    assert got[4]["event_time"].microsecond == 123456 and got[2]["sequence_number"] == 7
    assert all(r["payload"] == v for r, v in zip(got, values.values()))
    missing = validate_events(parse_feed(feed(spark, [None]))).first()
    assert missing["violation"] == "Event payload is missing"


def test_flatten_keeps_the_text(spark):
    a, b = '{"shipmentId":"x","unknown":1}', '{"shipmentId":"y"}'
    docs = spark.createDataFrame([(1, f"[{a},{b}]"), (2, a), (3, "[]")], "request_id long, document string")
    assert table(flatten_batches(docs), "request_id", "position", "key", "value") == [
        (1, 0, "x", a), (1, 1, "y", b), (2, 0, "x", a)]


# --- failures, pages, reports --------------------------------------------------------------------

def failure(n, event_id, at, category="SHIPMENT_NOT_FOUND", message="m"):
    return (event_id, "s", f"payload{n}", category, "Type", message, "t", 0, n, T0 + timedelta(seconds=at), n)


FAILURE = ("event_id string, shipment_id string, payload string, error_category string, error_type string, "
           "error_message string, original_topic string, original_partition int, original_offset long, "
           "failed_at timestamp, arrival long")


def test_failures_collapse_and_reopen(spark):
    first = spark.createDataFrame([failure(1, "a", 1), failure(2, None, 2), failure(3, None, 3),
                                   failure(4, "a", 4, "UNKNOWN_EVENT_TYPE")], FAILURE)
    one = failures.failed_events_upsert(None, first)
    columns = ["event_id", "payload", "error_category", "status", "retry_count", "version", "first_failed_at", "last_failed_at"]
    t = lambda s: T0 + timedelta(seconds=s)
    assert sorted((tuple(r) for r in one.select(*columns).collect()), key=str) == sorted([
        ("a", "payload1", "UNKNOWN_EVENT_TYPE", "FAILED", 0, 1, t(1), t(4)),
        (None, "payload2", "SHIPMENT_NOT_FOUND", "FAILED", 0, 0, t(2), t(2)),
        (None, "payload3", "SHIPMENT_NOT_FOUND", "FAILED", 0, 0, t(3), t(3))], key=str)
    resolved = one.withColumn("status", F.when(F.col("event_id") == "a", "RESOLVED").otherwise(F.col("status")))
    again = failures.failed_events_upsert(resolved, spark.createDataFrame(
        [failure(9, "a", 9, message="x" * 2001), failure(10, "b", 10)], FAILURE))
    rows = {r["event_id"]: r for r in again.where("event_id IS NOT NULL").collect()}
    assert again.count() == 4
    assert (rows["a"]["status"], rows["a"]["version"], rows["a"]["payload"]) == ("FAILED", 2, "payload1")
    assert rows["a"]["first_failed_at"] == t(1) and rows["a"]["last_failed_at"] == t(9)
    assert rows["a"]["error_message"] == "x" * 1997 + "..." and rows["b"]["version"] == 0


def test_quantiles_interpolate(spark):
    hist = spark.createDataFrame([("APPLIED", 1.0, 10), ("APPLIED", 2.0, 30), ("APPLIED", None, 40)],
                                 "processing_status string, le double, cumulative long")
    got = {q: s for _, q, s in table(reports.lag_quantiles(hist, [0.125, 0.5, 0.99]), "processing_status", "quantile", "seconds")}
    assert got == {0.125: 0.5, 0.5: 1.5, 0.99: 2.0}


def test_sustained_needs_the_whole_span(spark):
    flags = [True, True, False, True, True, True, True]
    rows = [("r", T0 + timedelta(minutes=i), f, 120) for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "rule string, window_end timestamp, holds boolean, hold_seconds int")
    got = [f for _, f in table(rates.sustained(df, 60), "window_end", "firing")]
    assert got == [False, False, False, False, False, True, True]


def test_page_limits(spark):
    with pytest.raises(ValueError):
        pages.history_page(shipments(spark), size=201)
    with pytest.raises(ValueError):
        pages.retailer_page(shipments(spark), page=-1)


def test_dead_letter_records_carry_their_origin(spark):
    letters = failures.dead_letters(spark.createDataFrame([failure(7, "a", 1)], FAILURE))
    row = dead_letter_records(letters).first()
    assert (row["key"], row["value"]) == ("s", "payload7")
    headers = {h["key"]: bytes(h["value"]).decode() for h in row["headers"]}
    assert headers["original-topic"] == "t" and headers["original-offset"] == "7"
    assert headers["exception-message"] == "m"


def test_detection_is_the_default(spark, monkeypatch):
    """A feed with one crowded shipment takes the chunked path without being told."""
    from waybill.operators import skew
    monkeypatch.setattr(skew, "find_heavy", lambda df, keys, policy=None, real=skew.find_heavy: real(df, keys, EAGER))
    journeys = {"big": [(i % 7 + 1, i % 3, i, "IN_TRANSIT") for i in range(40)], "small": [(1, 1, 0, "DELAYED")]}
    folded = fold.ordering_fold(stored(spark, journeys))
    assert "_chunk" in folded._jdf.queryExecution().analyzed().toString()
    assert "_carried" in folded._jdf.queryExecution().analyzed().toString()
    assert applied(folded) == {name: sequential(steps) for name, steps in journeys.items()}


def test_text_bound_counts_code_units(spark):
    """A character beyond the basic plane is two units and is never cut in half."""
    from waybill.functions.columns import bounded
    texts = ["a" * 2000, "a" * 2001, "\U0001f600" * 1500, "a" + "\U0001f600" * 1500, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(bounded(F.col("t"), 2000).alias("t"))
    got = [r["t"] for r in df.collect()]
    assert got == ["a" * 2000, "a" * 1997 + "...", "\U0001f600" * 998 + "...", "a" + "\U0001f600" * 998 + "...", None]


def test_wire_instants_are_utc_in_any_session_zone(spark):
    from waybill.functions import wire_json
    df = events(spark, [event(1)]).withColumn("event_time", F.expr("timestamp '2026-08-01 10:00:00 UTC'"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert '"eventTime":"2026-08-01T10:00:00.000000Z"' in df.select(wire_json(df).alias("j")).first()["j"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
