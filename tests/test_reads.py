"""Pages after a row, look-ups, alerts over a sparse feed, ranges of offsets, and the plans they get."""

import random
import re
from datetime import timedelta

import pytest

from helpers import F, T0, event, events, feed, shipments, table, uuid_of, wire
from waybill import model as M
from waybill.operators import pages, rates, reports
from waybill.operators.skew import SkewPolicy
from waybill.plans.pipeline import outcome_stream
from waybill.sources import read_feed, read_tables
from waybill.sources.store import Store
from waybill.streaming import IngestConfig, start


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- pages ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def history(spark):
    pick = random.Random(5)
    rows = [(f"e{n:03d}", f"s{n % 3}", T0 + timedelta(hours=pick.randrange(6)) if pick.random() < 0.9 else None,
             pick.choice([1, 2, None])) for n in range(90)]
    df = spark.createDataFrame(rows, "event_id string, shipment_id string, event_time timestamp, sequence_number long")
    rest = [f for f in M.history_schema().fields if f.name not in df.columns]
    return df.select(*df.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])


@pytest.mark.parametrize("size", [1, 4, 7])
def test_pages_after_a_row_meet_without_gap_or_repeat(spark, history, size):
    """Ties and NULLs in the order columns included."""
    want = {s: [r["event_id"] for r in history.where(F.col("shipment_id") == s).orderBy(
        "event_time", "sequence_number", "event_id").collect()] for s in ("s0", "s1", "s2")}
    got = {s: [] for s in want}
    page = pages.history_page(history, page=0, size=size).cache()
    for _ in range(40 if size > 1 else 4):
        rows = sorted(page.collect(), key=lambda r: (r["shipment_id"], r["position"]))
        if not rows:
            break
        for r in rows:
            got[r["shipment_id"]].append(r["event_id"])
            assert r["position"] == len(got[r["shipment_id"]]) and r["total_elements"] == 30
        assert {r["has_next"] for r in rows} == {len(got["s0"]) < 30}
        # the client holds the last rows of what it has seen
        cursors = spark.createDataFrame([tuple(r) for r in pages.last_rows(page, "shipment_id").collect()],
                                        "shipment_id string, position int, event_time timestamp, sequence_number long, event_id string")
        page = pages.history_after(history, cursors, size)
    assert got == (want if size > 1 else {s: w[:4] for s, w in want.items()})


def test_a_deep_page_is_limited_below_the_shuffle(spark, history):
    cursors = spark.createDataFrame([("s1", 5_000_000, T0, 1, "e000")],
                                    "shipment_id string, position int, event_time timestamp, sequence_number long, event_id string")
    plan = plan_of(pages.history_after(history, cursors, 20))
    lines = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    assert lines and any("Exchange" in line for line in plan.splitlines()[:lines[0]])


def test_pages_of_failed_events_come_in_order(spark):
    rows = [(f"f{n:02d}", f"e{n}", "s", "p", "SHIPMENT_NOT_FOUND" if n % 2 else "UNKNOWN", "T", "m", 0,
             "FAILED", "t", 0, n, T0, T0 + timedelta(seconds=n // 4) if n else None, 0) for n in range(23)]
    failed = spark.createDataFrame(rows, M.failed_events_schema()).repartition(4)
    want = [r["failed_event_id"] for r in failed.orderBy(F.col("last_failed_at").desc_nulls_last(), "failed_event_id").collect()]
    got, last = [], None
    while True:
        page = pages.failed_events_after(failed, M.error_categories(spark), last, size=5).collect()
        assert [r["position"] for r in page] == list(range(len(got) + 1, len(got) + 1 + len(page)))
        got += [r["failed_event_id"] for r in page]
        last = page[-1].asDict()
        if not last["has_next"]:
            break
    assert got == want


def test_look_ups_answer_unknown_ids(spark):
    ids = spark.createDataFrame([("s1",), ("s1",), ("s9",), (None,)], "shipment_id string")
    got = pages.look_up(ids, shipments(spark, ["s1", "s2"]), "shipment_id", pages.shipment_view)
    assert sorted((tuple(r) for r in got.select("shipment_id", "tracking_number", "found").collect()), key=str) == sorted(
        [("s1", "SP-s1", True), ("s9", None, False), (None, None, False)], key=str)


# --- time ----------------------------------------------------------------------------------------

def received(spark, minutes):
    rows = [event(n, event_id=f"e{n}") for n in range(len(minutes))]
    for row, minute in zip(rows, minutes):
        row["received_at"] = T0 + timedelta(minutes=minute, seconds=5)
    return outcome_stream(events(spark, rows), shipments(spark), policy=SkewPolicy())


def test_a_stray_reception_costs_some_days_only(spark):
    year = 365 * 24 * 60
    spine = rates.time_spine(received(spark, [0, 10, 80 * year]), 60)
    rows = spine.count()
    assert rows < 2 * (rates.SILENT_DAYS + 1) * 1440 and rows == spine.distinct().count()
    low, high = spine.agg(F.min("window_end"), F.max("window_end")).first()
    assert low == T0 + timedelta(minutes=1) and high == T0 + timedelta(minutes=80 * year + 1)
    near = rates.time_spine(received(spark, [0, 3000]), 60, extra=120)
    assert near.count() == 3003                                    # over days without any reception as well
    odd = rates.time_spine(received(spark, [0, 3000]), 420)        # a step that does not divide the day
    assert odd.count() == 3000 // 7 + 1 and table(odd.select(F.unix_timestamp("window_end").alias("t")), "t")[0][0] % 420 == 0


def test_alerts_over_a_gap_and_their_plan(spark):
    outcomes = received(spark, [0, 1, 2, 100])
    gauges = spark.createDataFrame([("review_backlog", T0 + timedelta(minutes=m), 30.0) for m in range(1, 40)],
                                   "gauge string, window_end timestamp, value double")
    got = rates.alerts(outcomes, gauges, [60.0, 3600.0, 86400.0 * 40], rates.AlertRules(latency=1.0))
    plan = plan_of(got)
    assert len(re.findall(r"\bExchange\b", plan)) <= 8 and "CartesianProduct" not in plan
    rows = {(r["rule"], round((r["window_end"] - T0).total_seconds() / 60)): (r["value"], r["firing"]) for r in got.collect()}
    assert len(rows) == 6 * 101
    quiet = [m for (rule, m), (_, firing) in rows.items() if rule == "NoEventsReceived" and firing]
    assert sorted(quiet) == list(range(18 + 30, 101))              # silent from minute 18 on, for 30 minutes, until 101
    backlog = [m for (rule, m), (_, firing) in rows.items() if rule == "FailedEventsAwaitingReview" and firing]
    assert sorted(backlog) == list(range(16, 40))
    assert rows["NoEventsReceived", 3][0] == 3 / 900 and rows["ConsumerLagGrowing", 3] == (None, False)


def test_quantiles_from_one_row(spark):
    edges = [1.0, 2.0, 4.0]
    df = spark.createDataFrame([(0, 0, 0, 0), (1, 1, 1, 1), (0, 4, 4, 8), (2, 2, 6, 6)], "_le0 long, _le1 long, _le2 long, _le3 long")
    got = [tuple(r) for r in df.select(*[reports.quantile_of([F.col(f"_le{i}") for i in range(4)], edges, F.lit(q)).alias(f"q{i}")
                                         for i, q in enumerate((0.25, 0.5, 0.99))]).collect()]
    assert got[0] == (None, None, None) and got[1] == (0.25, 0.5, 0.99)
    assert got[2][:2] == (1.5, 2.0) and got[2][2] == 4.0           # above the last edge: that edge
    long = df.withColumn("id", F.monotonically_increasing_id())
    rows = reports.lag_quantiles(reports.histogram_rows(long, ["id"], edges), [0.25, 0.5, 0.99], by=["id"])
    flat = {}
    for r in rows.collect():
        flat.setdefault(r["id"], {})[r["quantile"]] = r["seconds"]
    want = [g for g in got if g[0] is not None]
    assert sorted(tuple(flat[i][q] for q in (0.25, 0.5, 0.99)) for i in flat) == sorted(want)


# --- the feed source -----------------------------------------------------------------------------

def test_ranges_of_offsets_reach_the_files(spark, tmp_path):
    rows = [("k", f"v{n}", "t", n % 3, n // 3, T0) for n in range(60)]
    spark.createDataFrame(rows, M.FEED_SCHEMA).write.parquet(str(tmp_path / "feed"))
    got = read_feed(spark, str(tmp_path / "feed"), offsets={0: (5, 8), 2: (None, 2), 1: (19, None)})
    assert table(got, "partition", "offset") == [(0, 5), (0, 6), (0, 7), (1, 19), (2, 0), (2, 1)]
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(offset,5)" in pushed and "EqualTo(partition,0)" in pushed


def test_broker_ranges(spark):
    from waybill.sources.feed import _broker_range
    assert _broker_range("t", None, False) == {"subscribe": "t", "startingOffsets": "earliest"}
    assert _broker_range("t", {1: (5, 9), 0: (None, None)}, False) == {
        "assign": '{"t": [0, 1]}', "startingOffsets": '{"t": {"1": 5, "0": -2}}', "endingOffsets": '{"t": {"1": 9, "0": -1}}'}
    assert "endingOffsets" not in _broker_range("t", {1: (5, None)}, True)


def test_a_restarted_stream_goes_on_where_it_was(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    batch = store.begin()
    batch.put({"shipments": shipments(spark, [uuid_of(1)])})
    store.commit(batch, "register", 0)
    folder, config = str(tmp_path / "feed"), IngestConfig(retries=0)
    for n in range(2):                                             # the second run finds the first one's checkpoint
        feed(spark, [wire(2 * n), wire(2 * n + 1)], start=2 * n).coalesce(1).write.mode("append").parquet(folder)
        stream = read_feed(spark, folder, stream=True, offsets={0: (1, None)})
        start(stream, store, str(tmp_path / "checkpoint"), config).awaitTermination(120)
    assert table(store.read("tracking_events"), "event_id") == [(uuid_of(n),) for n in (1, 2, 3)]
    assert store.read("outcomes").count() == 3                     # nothing was read twice
    store.export(str(tmp_path / "plain"))
    plain = read_tables(spark, str(tmp_path / "plain"))
    for name in ("shipments", "tracking_events", "notifications", "failed_events"):
        assert table(plain[name], plain[name].columns[0]) == table(store.read(name), plain[name].columns[0])
