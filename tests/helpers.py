"""Small DataFrames for unit cases."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from waybill import model as M

T0 = datetime(2026, 8, 1, 10, 0, 0)
_EVENT = ("event_id string, schema_version int, shipment_id string, tracking_number string, "
          "carrier_code string, event_type string, event_time timestamp, sequence_number long, "
          "location string, description string, correlation_id string, arrival long, "
          "received_at timestamp, topic string, partition int, offset long")


def event(arrival, **over):
    row = dict(
        event_id=f"e{arrival}", schema_version=1, shipment_id="s1", tracking_number="SP-TEST-1",
        carrier_code="SWIFTPOST", event_type="SP_TRANSIT", sequence_number=arrival, location="Rivermouth",
        description=None, correlation_id="test-correlation", arrival=arrival, topic="t", partition=0,
        offset=arrival)
    row["received_at"] = T0 + timedelta(days=30, seconds=arrival)
    row.update(over)
    if "event_time" not in row:
        row["event_time"] = T0 + timedelta(hours=row["sequence_number"] or 0)
    return row


def events(spark, rows):
    names = [c.split()[0] for c in _EVENT.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], _EVENT)


def shipments(spark, ids=("s1",), **over):
    names = M.shipments_schema().fieldNames()
    rows = []
    for i in ids:
        row = dict(shipment_id=i, retailer_id="retailer-1", customer_id="cust-1", tracking_number=f"SP-{i}",
                   carrier_code="SWIFTPOST", current_status="LABEL_CREATED", estimated_delivery_date=None,
                   last_event_time=None, last_sequence_number=None, last_received_at=None, version=0,
                   created_at=T0, updated_at=T0)
        row.update(over)
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, M.shipments_schema())


def uuid_of(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def wire(n, shipment=1, sequence=1, code="SP_TRANSIT", carrier="SWIFTPOST", **over):
    body = dict(eventId=uuid_of(n), schemaVersion=1, shipmentId=uuid_of(shipment), trackingNumber="SP-TEST-1",
                carrierCode=carrier, eventType=code,
                eventTime=(T0 + timedelta(hours=sequence)).strftime("%Y-%m-%dT%H:%M:%SZ"),
                sequenceNumber=sequence, location="Rivermouth", description=None, correlationId="c")
    body.update(over)
    return json.dumps(body)


def feed(spark, values, start=0, at=None):
    """Broker records; one second apart, offsets from ``start``."""
    base = (at or T0 + timedelta(days=30)).replace(tzinfo=timezone.utc)
    rows = [("k", v, "t", 0, start + i, base + timedelta(seconds=start + i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, M.FEED_SCHEMA)


def outcomes_of(df):
    return {r["event_id"]: r["outcome"] for r in df.select("event_id", "outcome").collect()}


def table(df, *columns, sort=None):
    return sorted(tuple(r) for r in df.select(*columns).collect())


