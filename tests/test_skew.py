"""Heavy keys: the pieces path gives the rows of the plain one, over the arrival order of a broker."""

import random
from collections import Counter
from datetime import timedelta

import pytest

from helpers import F, T0, event, events, shipments
from waybill.operators import fold
from waybill.operators.skew import SkewPolicy, find_heavy, find_shared, in_pieces
from waybill.plans.pipeline import outcome_stream

PLAIN = SkewPolicy()


def broker_feed(spark, seed, rows=300):
    """Several topics with partitions, a crowded shipment and id, a burst in one partition, and records read twice."""
    pick = random.Random(seed)
    offsets, out = Counter(), []
    for n in range(rows):
        burst = n >= rows * 2 // 3
        place = ("e", 3) if burst else (pick.choice("aez"), pick.randrange(3))
        offset = (1 << 40) + offsets[place] if place[0] == "z" else offsets[place]
        offsets[place] += 1
        row = event(n, event_id="hot" if pick.random() < 0.3 else None if pick.random() < 0.05 else f"e{pick.randrange(rows)}",
                    shipment_id="s1" if burst or pick.random() < 0.4 else f"s{pick.randrange(2, 30)}",
                    sequence_number=pick.randrange(1, 40), topic=place[0], partition=place[1], offset=offset,
                    carrier_code="PACIFICA" if pick.random() < 0.1 else "SWIFTPOST",
                    event_type=pick.choice(["SP_TRANSIT", "SP_DELAY", "SP_OFD", "SP_DEPOT"] * 8 + ["SP_DELIVERED"]))
        row["received_at"] = T0 + timedelta(days=30, seconds=pick.randrange(50))
        out += [row] * (2 if pick.random() < 0.2 else 1)
    return events(spark, out).withColumn("arrival", F.struct("topic", "partition", "offset"))


def rows_of(df, *columns):
    return Counter(repr(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_equal_the_plain_path(spark, seed):
    df, parcels = broker_feed(spark, seed), shipments(spark, [f"s{i}" for i in range(1, 27)])
    columns = ["event_id", "shipment_id", "arrival", "is_duplicate", "applied", "outcome"]
    plain = outcome_stream(df, parcels, policy=PLAIN)
    want = rows_of(plain, *columns)
    history = rows_of(fold.applied_timeline(plain.where("stored"), heavy=None), "arrival", "status_before", "status_after")
    for policy in (SkewPolicy(heavy_rows=20, sample_every=1, chunk_rows=16), SkewPolicy(heavy_rows=3, sample_every=1, chunk_rows=2)):
        assert set(find_heavy(df, ["event_id", "shipment_id"], policy)) == {"event_id", "shipment_id"}
        assert rows_of(outcome_stream(df, parcels, policy=policy), *columns) == want
        stored = plain.where("stored")
        heavy = find_heavy(stored, ["shipment_id"], policy)["shipment_id"]
        assert rows_of(fold.applied_timeline(stored, heavy=heavy), "arrival", "status_before", "status_after") == history


def test_a_record_read_twice_is_stored_once_on_both_paths(spark):
    one = events(spark, [event(5, event_id="hot")]).withColumn("arrival", F.struct("topic", "partition", "offset"))
    rest = events(spark, [event(n, event_id="hot") for n in range(6, 30)]).withColumn(
        "arrival", F.struct("topic", "partition", "offset"))
    df = one.union(one).union(rest)
    for policy in (PLAIN, SkewPolicy(heavy_rows=3, sample_every=1, chunk_rows=4)):
        got = outcome_stream(df, shipments(spark), policy=policy)
        assert got.where("stored").count() == 1 and got.where("outcome = 'DUPLICATE'").count() == 25


@pytest.mark.parametrize("arrival", ["same leading value", "burst at the end"])
def test_pieces_hold_equal_numbers_of_rows(spark, arrival):
    n, policy = 6000, SkewPolicy(heavy_rows=100, sample_every=1, chunk_rows=400)
    offset = F.col("id") if arrival == "same leading value" else F.col("id") + F.when(F.col("id") < 50, 0).otherwise(1 << 50)
    df = spark.range(n).select(F.lit("s1").alias("shipment_id"), F.struct(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), offset.alias("offset")).alias("arrival"))
    cut = in_pieces(df, "shipment_id", find_heavy(df, ["shipment_id"], policy)["shipment_id"])
    sizes = cut.groupBy("_chunk").agg(F.count("*").alias("n"), F.min("arrival").alias("low"), F.max("arrival").alias("high"))
    rows = sizes.orderBy("_chunk").collect()
    assert sum(r["n"] for r in rows) == n and max(r["n"] for r in rows) <= policy.chunk_rows and len(rows) >= n // 400
    assert all(a["high"]["offset"] < b["low"]["offset"] for a, b in zip(rows, rows[1:]))      # in arrival order


TOGETHER = SkewPolicy(together_rows=0)


def shared_feed(spark, seed, rows=240):
    """Broker rows whose ids several shipments share, that lack ids or shipments, or come with one arrival in two
    shipments."""
    pick = random.Random(seed)
    out = []
    for n in range(rows):
        row = event(n, event_id=None if pick.random() < 0.05 else f"e{pick.randrange(rows // 2)}",
                    sequence_number=pick.randrange(1, 40), offset=n,
                    carrier_code="PACIFICA" if pick.random() < 0.1 else "SWIFTPOST",
                    event_type=pick.choice(["SP_TRANSIT", "SP_DELAY", "SP_OFD"] * 6 + ["SP_DELIVERED", "SP_NONE"]))
        home = f"s{pick.randrange(1, 12)}" if row["event_id"] is None or pick.random() < 0.2 else f"s{int(row['event_id'][1:]) % 9}"
        row["shipment_id"] = None if pick.random() < 0.05 else home
        out += [row] * (2 if pick.random() < 0.2 else 1)
    return events(spark, out)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(line.strip(" +-:").startswith("Exchange hashpartitioning") for line in plan.splitlines())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_shuffle_by_shipment_equals_the_plain_path(spark, seed):
    df, parcels = shared_feed(spark, seed), shipments(spark, [f"s{i}" for i in range(0, 10)])
    together, shared = find_shared(df, TOGETHER)
    assert together and shared.rows.count() > 5
    plain, one = outcome_stream(df, parcels, policy=PLAIN), outcome_stream(df, parcels, policy=TOGETHER)
    assert one.columns == plain.columns and one.dtypes == plain.dtypes
    assert rows_of(one, *plain.columns) == rows_of(plain, *plain.columns)
    assert len({r["outcome"] for r in one.collect()}) >= 6
    few = SkewPolicy(together_rows=0, shared_ids=2)
    assert find_shared(df, few) == (False, None)
    assert rows_of(outcome_stream(df, parcels, policy=few), *plain.columns) == rows_of(plain, *plain.columns)


def test_copies_with_one_arrival_in_two_shipments_are_stored_once(spark):
    rows = [event(4, event_id="e1", shipment_id=s) for s in ("s2", "s1", "s3", "s1")] + [
        event(2, event_id="e1", shipment_id="unknown"), event(9, event_id="e1", shipment_id="s1"), event(5, event_id="e2")]
    got = outcome_stream(events(spark, rows), shipments(spark, ["s1", "s2", "s3"]), policy=TOGETHER)
    assert Counter(r["outcome"] for r in got.collect()) == {"APPLIED": 2, "DUPLICATE": 4, "SHIPMENT_NOT_FOUND": 1}


def test_a_large_feed_of_unshared_ids_is_shuffled_once(spark):
    df = events(spark, [event(n, event_id=f"e{n % 40}", shipment_id=f"s{n % 8}") for n in range(80)])
    parcels = shipments(spark, [f"s{i}" for i in range(8)])
    assert find_shared(df, TOGETHER) == (True, None)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as with many shipments
    try:
        one, plain = outcome_stream(df, parcels, policy=TOGETHER), outcome_stream(df, parcels, policy=PLAIN)
        assert exchanges(one) == 2 and exchanges(plain) == 4       # one of them each are the shipments
        assert rows_of(one, *plain.columns) == rows_of(plain, *plain.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
