"""The same queries as plain SQL over the driver's tables.

Written independently of the operators: the fold compares text-encoded keys in running windows,
redeliveries are found row by row, pages are numbered in full.

Fixed values in the statements below: carrier codes, statuses, error categories, the texts of violations and
error messages, limits of lengths, page sizes, and the alerts' names, thresholds and hold times.
"""

from __future__ import annotations

import re

from .. import model as M

ORACLE: dict[str, str] = {}


def _values(rows) -> str:
    def lit(v):
        return str(v).upper() if isinstance(v, bool) else "'" + v + "'"
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


CTE: dict[str, str] = {}

CTE["vocab"] = f"vocab(carrier_code, code, status) AS ({_values(M.VOCABULARY)})"
CTE["categories"] = f"categories(error_category, auto_retry, manual_retry) AS ({_values(M.ERROR_CATEGORIES)})"
CTE["rules"] = f"rules(notification_type) AS ({_values([(s,) for s in M.NOTIFIABLE])})"

_CARRIER = """CASE WHEN {k} % 10 = 8 THEN 'NORDEX' WHEN {k} % 10 = 9 THEN 'METROLINK'
       WHEN {k} % 2 = 0 THEN 'SWIFTPOST' ELSE 'PACIFICA' END"""
_NUMBER = "concat('SP', lpad(CAST({k} AS VARCHAR), 12, '0'))"

CTE["customers"] = f"""customers AS (
  SELECT c_custkey AS shipment_id, concat('retailer-', CAST(c_nationkey AS VARCHAR)) AS retailer_id,
    c_name AS customer_id, {_NUMBER.format(k='c_custkey')} AS tracking_number,
    {_CARRIER.format(k='c_custkey')} AS carrier_code, 'LABEL_CREATED' AS current_status,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS DATE) AS estimated_delivery_date,
    CAST(NULL AS TIMESTAMP) AS last_event_time, CAST(NULL AS BIGINT) AS last_sequence_number,
    CAST(NULL AS TIMESTAMP) AS last_received_at, CAST(0 AS BIGINT) AS version,
    make_timestamp((1700000000 + c_custkey % 997) * 1000000) AS created_at,
    make_timestamp((1700000000 + c_custkey % 997) * 1000000) AS updated_at
  FROM customer)"""
CTE["shipments"] = "shipments AS (SELECT * FROM customers WHERE shipment_id % 17 <> 0)"

CTE["feed"] = f"""base AS (
  SELECT event_id, ts, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
    (SELECT max(ts) FROM events) AS t_end
  FROM events),
sent AS (
  SELECT base.*, event_id * 2 AS arrival FROM base
  UNION ALL
  SELECT base.*, (event_id + 7) * 2 + 1 AS arrival FROM base WHERE k % 10 = 3),
feed AS (
  SELECT event_id, CASE WHEN k = 50 THEN 2 ELSE 1 END AS schema_version, user_id AS shipment_id,
    {_NUMBER.format(k='user_id')} AS tracking_number,
    CASE WHEN k = 51 THEN 'SWIFTPOST' ELSE {_CARRIER.format(k='user_id')} END AS carrier_code,
    CASE WHEN k = 52 THEN 'SP_TELEPORTED'
       WHEN user_id % 2 = 0 OR k = 51 THEN
         CASE k % 7 WHEN 0 THEN 'SP_PICKUP' WHEN 1 THEN ' sp_transit ' WHEN 2 THEN 'SP_DEPOT'
              WHEN 3 THEN 'SP_OFD' WHEN 4 THEN 'SP_DELAY' WHEN 5 THEN 'SP_ATTEMPT'
              ELSE CASE WHEN k >= 97 THEN 'SP_DELIVERED' ELSE 'SP_CREATED' END END
       ELSE CASE k % 7 WHEN 0 THEN 'COLLECTED' WHEN 1 THEN 'moving' WHEN 2 THEN 'AT_TERMINAL'
              WHEN 3 THEN 'COURIER_ROUTE' WHEN 4 THEN 'EXCEPTION_DELAY' WHEN 5 THEN 'DELIVERY_FAILED'
              ELSE CASE WHEN k >= 97 THEN 'COMPLETE' ELSE 'MANIFESTED' END END
    END AS event_type,
    ts AS event_time,
    CAST(floor(event_id / 100) AS BIGINT) + 1 - CASE WHEN k < 10 THEN 5 * (k + 1) ELSE 0 END AS sequence_number,
    CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS description,
    concat('corr-', CAST(user_id AS VARCHAR)) AS correlation_id, arrival,
    t_end + INTERVAL 1 SECOND * arrival AS received_at,
    'carrier-tracking-events' AS topic, CAST(user_id % 6 AS INTEGER) AS part, arrival AS off
  FROM sent)"""

# the wire form of a feed row
_JSON = """concat('{"eventId":', event_id, ',"schemaVersion":', schema_version, ',"shipmentId":', shipment_id,
   ',"trackingNumber":"', tracking_number, '","carrierCode":"', carrier_code, '","eventType":"', event_type,
   '","eventTime":"', strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f'), 'Z","sequenceNumber":', sequence_number,
   ',"correlationId":"', correlation_id, '"}')"""

CTE["assessed"] = """assessed AS (
  SELECT f.*, s.carrier_code AS registered_carrier, v.status AS normalized_event_type,
    CASE WHEN f.schema_version <> 1 THEN concat('Unsupported schema version ', f.schema_version,
              '; this service understands version 1')
         WHEN f.sequence_number <= 0 THEN 'Event failed validation: sequenceNumber must be greater than 0'
    END AS violation,
    f.carrier_code IN (SELECT carrier_code FROM vocab) AS supported
  FROM feed f LEFT JOIN shipments s ON s.shipment_id = f.shipment_id
  LEFT JOIN vocab v ON v.carrier_code = f.carrier_code AND v.code = upper(trim(f.event_type)))"""

CTE["outcomes"] = """flagged AS (
  SELECT *, violation IS NULL AND registered_carrier IS NOT NULL AND registered_carrier = carrier_code
      AND supported AND normalized_event_type IS NOT NULL AS storable FROM assessed),
deduped AS (
  SELECT *, violation IS NULL AND coalesce(max(CASE WHEN storable THEN 1 ELSE 0 END) OVER (
      PARTITION BY event_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
    AS is_duplicate FROM flagged),
keyed AS (
  SELECT *, storable AND NOT is_duplicate AS stored,
    CASE WHEN storable AND NOT is_duplicate THEN concat(lpad(CAST(sequence_number AS VARCHAR), 12, '0'),
      lpad(CAST(epoch_us(event_time) AS VARCHAR), 18, '0'), lpad(CAST(epoch_us(received_at) AS VARCHAR), 18, '0'))
    END AS key FROM deduped),
ranked AS (
  SELECT *, max(key) OVER (PARTITION BY shipment_id ORDER BY arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM keyed),
winning AS (SELECT *, stored AND (best IS NULL OR key >= best) AS wins FROM ranked),
folded AS (
  SELECT *, wins AND coalesce(max(CASE WHEN wins AND normalized_event_type = 'DELIVERED' THEN 1 ELSE 0 END) OVER (
      PARTITION BY shipment_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0
    AS applied FROM winning),
named AS (
  SELECT *, CASE WHEN violation IS NOT NULL THEN 'VALIDATION' WHEN is_duplicate THEN 'DUPLICATE'
     WHEN registered_carrier IS NULL THEN 'SHIPMENT_NOT_FOUND'
     WHEN registered_carrier <> carrier_code THEN 'CARRIER_MISMATCH'
     WHEN NOT supported THEN 'UNSUPPORTED_CARRIER' WHEN normalized_event_type IS NULL THEN 'UNKNOWN_EVENT_TYPE'
     WHEN applied THEN 'APPLIED' ELSE 'SUPERSEDED' END AS outcome FROM folded),
outcomes AS (
  SELECT *, CASE WHEN outcome NOT IN ('APPLIED', 'SUPERSEDED', 'DUPLICATE') THEN outcome END AS error_category
  FROM named)"""

CTE["history"] = """history AS (
  SELECT event_id, shipment_id, tracking_number, carrier_code, event_type AS carrier_event_type,
    normalized_event_type, event_time, received_at, sequence_number, location, description, correlation_id,
    outcome AS processing_status, arrival
  FROM outcomes WHERE stored)"""

CTE["state"] = """state AS (
  SELECT s.shipment_id, s.retailer_id, s.customer_id, s.tracking_number, s.carrier_code,
    coalesce(d.status, s.current_status) AS current_status, s.estimated_delivery_date,
    d.event_time AS last_event_time, d.sequence_number AS last_sequence_number,
    d.received_at AS last_received_at, coalesce(d.n, 0) AS version, s.created_at,
    coalesce(d.received_at, s.updated_at) AS updated_at
  FROM shipments s LEFT JOIN (
    SELECT shipment_id, arg_max(normalized_event_type, arrival) AS status, arg_max(event_time, arrival) AS event_time,
      arg_max(sequence_number, arrival) AS sequence_number, arg_max(received_at, arrival) AS received_at,
      count(*) AS n
    FROM outcomes WHERE applied GROUP BY shipment_id) d USING (shipment_id))"""

CTE["notifications"] = """notifications AS (
  SELECT uuid_of(concat(shipment_id, '|', event_id)) AS notification_id, shipment_id, event_id AS source_event_id,
    normalized_event_type AS notification_type, 'EMAIL' AS channel, 'PENDING' AS status, received_at AS created_at,
    arrival
  FROM outcomes WHERE applied AND normalized_event_type IN (SELECT notification_type FROM rules))"""

CTE["failures"] = f"""failures AS (
  SELECT event_id, shipment_id, {_JSON} AS payload, error_category,
    CASE error_category WHEN 'VALIDATION' THEN 'InvalidCarrierEventException'
      WHEN 'SHIPMENT_NOT_FOUND' THEN 'ShipmentNotFoundException'
      WHEN 'CARRIER_MISMATCH' THEN 'CarrierMismatchException'
      WHEN 'UNSUPPORTED_CARRIER' THEN 'UnsupportedCarrierException'
      ELSE 'UnknownCarrierEventTypeException' END AS error_type,
    CASE error_category WHEN 'VALIDATION' THEN violation
      WHEN 'SHIPMENT_NOT_FOUND' THEN concat('Shipment ', shipment_id, ' not found')
      WHEN 'CARRIER_MISMATCH' THEN concat('Shipment ', shipment_id, ' is registered with carrier ',
          registered_carrier, ' but the event claims ', carrier_code)
      WHEN 'UNSUPPORTED_CARRIER' THEN concat('No event normalizer is registered for carrier ', carrier_code)
      ELSE concat('Carrier ', carrier_code, ' sent unrecognised event type ''', event_type, '''') END AS error_message,
    topic, part, off, received_at AS failed_at, arrival
  FROM outcomes WHERE error_category IS NOT NULL)"""

CTE["failed"] = """failed AS (
  SELECT uuid_of(CAST(event_id AS VARCHAR)) AS failed_event_id, event_id,
    arg_min(shipment_id, arrival) AS shipment_id, arg_min(payload, arrival) AS payload,
    arg_max(error_category, arrival) AS error_category, arg_max(error_type, arrival) AS error_type,
    arg_max(error_message, arrival) AS error_message, CAST(0 AS INTEGER) AS retry_count, 'FAILED' AS status,
    arg_min(topic, arrival) AS original_topic, arg_min(part, arrival) AS original_partition,
    arg_min(off, arrival) AS original_offset, min(failed_at) AS first_failed_at, max(failed_at) AS last_failed_at,
    count(*) - 1 AS version
  FROM failures GROUP BY event_id)"""

CTE["middle"] = "middle AS (SELECT CAST(floor((min(arrival) + max(arrival)) / 2) AS BIGINT) AS cut FROM feed)"

CTE["feed_b"] = """feed_b AS (
  SELECT l_orderkey * 8 + l_linenumber AS event_id, l_orderkey AS shipment_id,
    CASE l_linenumber WHEN 1 THEN 'LABEL_CREATED' WHEN 2 THEN 'PICKED_UP' WHEN 3 THEN 'IN_TRANSIT'
      WHEN 4 THEN 'ARRIVED_AT_FACILITY' WHEN 5 THEN 'DELAYED' WHEN 6 THEN 'OUT_FOR_DELIVERY'
      ELSE 'DELIVERED' END AS normalized_event_type,
    l_shipdate AS event_time, CAST(l_linenumber AS BIGINT) AS sequence_number,
    make_timestamp((4000000000 + l_partkey) * 1000000) AS received_at, l_partkey AS off,
    row_number() OVER (ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax)
      AS arrival
  FROM lineitem)"""


def _fold_b(stored: str) -> str:
    return f"""keyed AS (
  SELECT *, {stored} AS stored, CASE WHEN {stored} THEN concat(lpad(CAST(sequence_number AS VARCHAR), 12, '0'),
      lpad(CAST(epoch_us(event_time) AS VARCHAR), 18, '0'), lpad(CAST(epoch_us(received_at) AS VARCHAR), 18, '0'))
    END AS key FROM deduped),
ranked AS (
  SELECT *, max(key) OVER (PARTITION BY shipment_id ORDER BY arrival
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM keyed),
winning AS (SELECT *, stored AND (best IS NULL OR key >= best) AS wins FROM ranked),
folded AS (
  SELECT *, wins AND coalesce(max(CASE WHEN wins AND normalized_event_type = 'DELIVERED' THEN 1 ELSE 0 END) OVER (
      PARTITION BY shipment_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0
    AS applied FROM winning)"""


CTE["fold_b"] = "deduped AS (SELECT * FROM feed_b),\n" + _fold_b("TRUE")
CTE["outcomes_b"] = """deduped AS (
  SELECT f.*, o_orderkey IS NOT NULL AS found,
    o_orderkey IS NOT NULL AND row_number() OVER (PARTITION BY event_id ORDER BY arrival) > 1 AS is_duplicate
  FROM feed_b f LEFT JOIN orders ON o_orderkey = shipment_id),
""" + _fold_b("found AND NOT is_duplicate") + """,
outcomes AS (
  SELECT *, CASE WHEN is_duplicate THEN 'DUPLICATE' WHEN NOT found THEN 'SHIPMENT_NOT_FOUND'
    WHEN applied THEN 'APPLIED' ELSE 'SUPERSEDED' END AS outcome,
    CASE WHEN NOT found THEN 'SHIPMENT_NOT_FOUND' END AS error_category FROM folded)"""
CTE["shipments_b"] = f"""shipments AS (
  SELECT o_orderkey AS shipment_id, concat('retailer-', CAST(o_custkey % 25 AS VARCHAR)) AS retailer_id,
    CAST(o_custkey AS VARCHAR) AS customer_id, {_NUMBER.format(k='o_orderkey')} AS tracking_number,
    'SWIFTPOST' AS carrier_code, 'LABEL_CREATED' AS current_status,
    CAST(CAST(o_orderdate AS DATE) + 7 AS DATE) AS estimated_delivery_date, o_orderdate AS created_at,
    o_orderdate AS updated_at FROM orders)"""

CTE["requests"] = f"""requests AS (
  SELECT o_orderkey AS request_id,
    CASE WHEN o_orderkey % 31 = 0 THEN '  ' ELSE concat('retailer-', CAST(o_custkey % 25 AS VARCHAR)) END AS retailer_id,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    {_NUMBER.format(k='o_custkey')} AS tracking_number,
    CASE WHEN o_orderkey % 41 = 0 THEN 'ACME' ELSE {_CARRIER.format(k='o_orderkey')} END AS carrier_code,
    CAST(CAST(o_orderdate AS DATE) + 7 AS DATE) AS estimated_delivery_date, o_orderdate AS requested_at
  FROM orders),
checked AS (
  SELECT *, CASE WHEN bad <> '' THEN concat(bad) END AS problem FROM (
    SELECT *, concat_ws(', ', CASE WHEN carrier_code = 'ACME' THEN 'carrierCode must not be null' END,
      CASE WHEN customer_id IS NULL THEN 'customerId must not be blank' END,
      CASE WHEN trim(retailer_id) = '' THEN 'retailerId must not be blank' END) AS bad FROM requests)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY carrier_code, tracking_number, problem IS NULL
      ORDER BY requested_at, request_id) AS rn,
    EXISTS (SELECT 1 FROM shipments s WHERE s.carrier_code = checked.carrier_code
      AND s.tracking_number = checked.tracking_number) AS taken FROM checked)"""

_METRICS = {
    "received": "count(*)", "processed": "count(*) FILTER (error_category IS NULL)",
    "applied": "count(*) FILTER (outcome = 'APPLIED')", "out_of_order": "count(*) FILTER (outcome = 'SUPERSEDED')",
    "duplicate": "count(*) FILTER (outcome = 'DUPLICATE')", "failed": "count(*) FILTER (error_category IS NOT NULL)",
    "dead_lettered": "count(*) FILTER (error_category IS NOT NULL)",
}
_A = ["vocab", "customers", "shipments", "feed", "assessed", "outcomes"]


def add(name: str, select: str, *ctes: str) -> None:
    head = "WITH " + ",\n".join(CTE[c] for c in ctes) + "\n" if ctes else ""
    ORACLE[name] = head + select


def add_a(name: str, select: str, *more: str) -> None:
    add(name, select, *_A, *more)


_OUT = """event_id, arrival, shipment_id, carrier_code, normalized_event_type, outcome, error_category, received_at"""

# --- sources -------------------------------------------------------------------------------------
add("feed_scan", f"""SELECT CAST(shipment_id AS VARCHAR) AS "key", {_JSON} AS "value", topic,
  part AS "partition", off AS "offset", received_at AS "timestamp" FROM feed""", "feed")

add("feed_range", f"""SELECT CAST(shipment_id AS VARCHAR) AS "key", {_JSON} AS "value", topic,
  part AS "partition", off AS "offset", received_at AS "timestamp" FROM feed
  WHERE (part = 0 AND off BETWEEN 50 AND 399) OR (part = 2 AND off < 300) OR (part = 3 AND off >= 100) OR part = 5""", "feed")
_BAD = "epoch_us(event_time) % 40 IN (0, 1, 3, 4, 6)"
_NONE = "epoch_us(event_time) % 40 IN (2, 5)"
add("parse_feed", "SELECT " + ", ".join(
    f"CASE WHEN NOT ({_BAD} OR {_NONE}) THEN {c} END AS {c}" for c in (
        "event_id", "schema_version", "shipment_id", "tracking_number", "carrier_code", "event_type", "event_time",
        "sequence_number", "correlation_id")) + f""",
  {_NONE} AS payload_missing,
  ({_BAD}) AND NOT (epoch_us(event_time) % 40 = 3 AND schema_version <> 1) AS malformed,
  off AS "offset", received_at FROM feed""", "feed")
# a version-2 row has no '"schemaVersion":1' to break, so it decodes
ORACLE["parse_feed"] = ORACLE["parse_feed"].replace(
    f"NOT ({_BAD} OR {_NONE})",
    f"(NOT ({_BAD} OR {_NONE}) OR (epoch_us(event_time) % 40 = 3 AND schema_version <> 1))")

add("flatten_batches", f"""SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY arrival) - 1 AS INTEGER)
  AS "position", CAST(shipment_id AS VARCHAR) AS "key", {_JSON} AS "value"
  FROM (SELECT *, CAST(floor(arrival / 10) AS BIGINT) AS request_id FROM feed)""", "feed")

# --- projections and predicates ------------------------------------------------------------------
_K = "epoch_us(event_time) % 40"
_DIRTY = f"""dirty AS (SELECT arrival, {_K} AS kind, event_id, schema_version, sequence_number FROM feed),
listed AS (
  SELECT *, list_sort([x for x in [
    CASE WHEN kind = 0 THEN 'eventId must not be null' END,
    CASE WHEN kind = 7 THEN 'shipmentId must not be null' END,
    CASE WHEN kind = 7 THEN 'eventTime must not be null' END,
    CASE WHEN kind = 9 THEN 'carrierCode must not be null' END,
    CASE WHEN kind = 12 THEN 'sequenceNumber must not be null' END,
    CASE WHEN kind IN (1, 12) THEN 'trackingNumber must not be blank' END,
    CASE WHEN kind = 2 THEN 'trackingNumber size must be between 0 and 128' END,
    CASE WHEN kind IN (3, 12) THEN 'eventType must not be blank' END,
    CASE WHEN kind = 13 THEN 'eventType size must be between 0 and 64' END,
    CASE WHEN kind = 5 THEN 'location size must be between 0 and 255' END,
    CASE WHEN kind = 6 THEN 'description size must be between 0 and 512' END,
    CASE WHEN kind = 4 THEN 'correlationId size must be between 0 and 64' END,
    CASE WHEN kind = 12 THEN 'correlationId must not be blank' END,
    CASE WHEN kind = 8 OR (sequence_number <= 0 AND kind <> 12) THEN 'sequenceNumber must be greater than 0' END
  ] if x is not null]) AS problems FROM dirty)"""
CTE["dirty"] = _DIRTY
add("validate_events", """SELECT arrival, CASE WHEN kind <> 0 THEN event_id END AS event_id,
  CASE WHEN kind = 10 THEN 'Unsupported schema version null; this service understands version 1'
       WHEN kind = 11 THEN 'Unsupported schema version 0; this service understands version 1'
       WHEN schema_version <> 1 THEN concat('Unsupported schema version ', schema_version,
            '; this service understands version 1')
       WHEN len(problems) > 0 THEN concat('Event failed validation: ', array_to_string(problems, ', '))
  END AS violation FROM listed""", "feed", "dirty")

add("normalize_events", """SELECT event_id, arrival, carrier_code, event_type, supported AS carrier_supported,
  normalized_event_type FROM assessed""", "vocab", "customers", "shipments", "feed", "assessed")
add("vocabulary_conflicts", """SELECT carrier_code, code, count(*) AS declarations FROM (
  SELECT DISTINCT carrier_code, upper(trim(event_type)) AS code, schema_version FROM feed)
  GROUP BY carrier_code, code HAVING count(*) > 1""", "feed")
add_a("classify_outcome", """SELECT event_id, arrival,
  CASE WHEN stored THEN 'STORED' ELSE outcome END AS outcome, error_category FROM outcomes""")
ORACLE["bound_error_text"] = """SELECT doc_id, source AS error_type,
  CASE WHEN length(text) <= 2000 THEN text ELSE concat(left(text, 1997), '...') END AS error_message FROM documents"""
add_a("shipment_view", """SELECT shipment_id, retailer_id, tracking_number, carrier_code, current_status,
  estimated_delivery_date, last_event_time, version, created_at, updated_at FROM state""", "state")

# --- joins ---------------------------------------------------------------------------------------
add("resolve_shipments", """SELECT f.event_id, f.arrival, f.shipment_id, f.carrier_code,
  s.carrier_code AS registered_carrier, s.shipment_id IS NOT NULL AS shipment_found,
  coalesce(s.carrier_code = f.carrier_code, FALSE) AS carrier_matches
  FROM feed f LEFT JOIN shipments s ON s.shipment_id = f.shipment_id""", "customers", "shipments", "feed")
for _name, _not in (("duplicates_semi", ""), ("new_events_anti", "NOT ")):
    add_a(_name, f"""SELECT event_id, arrival FROM feed WHERE arrival > (SELECT floor(cut / 2) FROM middle) AND event_id {_not}IN (
  SELECT event_id FROM outcomes WHERE stored AND arrival <= (SELECT cut FROM middle))""", "middle")
add_a("duplicate_report", """SELECT o.event_id, o.arrival, h.shipment_id, h.normalized_event_type AS stored_event_type,
  s.current_status, h.processing_status AS stored_processing_status, TRUE AS duplicate
  FROM outcomes o JOIN history h ON h.event_id = o.event_id LEFT JOIN state s ON s.shipment_id = h.shipment_id
  WHERE o.outcome = 'DUPLICATE'""", "history", "state")
# what the first batch stored comes again as a duplicate; the rest is as in one pass
add_a("incremental_outcomes", f"""SELECT event_id, arrival, shipment_id, carrier_code, normalized_event_type,
  CASE WHEN stored AND arrival <= cut THEN 'DUPLICATE' ELSE outcome END AS outcome, error_category, received_at
  FROM outcomes, middle WHERE arrival > floor(cut / 2)""", "middle")
add_a("incremental_state", "SELECT * FROM state", "state")
_NOTE = "notification_id, shipment_id, source_event_id, notification_type, channel, status, created_at"
add_a("notifications_new", f"SELECT {_NOTE} FROM notifications WHERE arrival > (SELECT cut FROM middle)",
      "rules", "notifications", "middle")
add_a("notification_cause", """SELECT n.notification_id, n.shipment_id, n.source_event_id, n.notification_type,
  n.created_at, h.carrier_event_type, h.normalized_event_type, h.event_time, h.sequence_number, h.processing_status
  FROM notifications n JOIN history h ON h.event_id = n.source_event_id""", "rules", "notifications", "history")
add_a("history_existence", """SELECT i.shipment_id, s.shipment_id IS NOT NULL AS found,
  CASE WHEN s.shipment_id IS NOT NULL THEN (SELECT count(*) FROM history h WHERE h.shipment_id = i.shipment_id) END
    AS total_elements
  FROM (SELECT DISTINCT shipment_id FROM feed) i LEFT JOIN shipments s ON s.shipment_id = i.shipment_id""", "history")
add_a("shipment_consistency", """SELECT shipment_id, current_status, last_sequence_number,
  (SELECT count(*) FROM history h WHERE h.shipment_id = state.shipment_id) AS events FROM state""", "history", "state")
add_a("backfill_last_received", """SELECT shipment_id, last_event_time, CASE WHEN last_event_time IS NOT NULL THEN
  (SELECT max(received_at) FROM history h WHERE h.shipment_id = state.shipment_id AND h.processing_status = 'APPLIED')
  END AS last_received_at FROM state""", "history", "state")

# --- windows and reductions ----------------------------------------------------------------------
add_a("mark_duplicates", "SELECT event_id, arrival, is_duplicate FROM outcomes")
add("ordering_fold", """SELECT event_id, shipment_id, off AS "offset", event_time, sequence_number,
  normalized_event_type, applied FROM folded""", "feed_b", "fold_b")
add_a("outcome_stream", f"SELECT {_OUT} FROM outcomes")
add_a("current_state", "SELECT * FROM state", "state")
add_a("shipments_upsert", """SELECT shipment_id, current_status, last_event_time, last_sequence_number, last_received_at,
  version, updated_at FROM state""", "state")
add_a("applied_timeline", """SELECT event_id, shipment_id, arrival, applied,
  coalesce(last_value(CASE WHEN applied THEN normalized_event_type END IGNORE NULLS) OVER (
    PARTITION BY shipment_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'LABEL_CREATED')
    AS status_before,
  coalesce(last_value(CASE WHEN applied THEN normalized_event_type END IGNORE NULLS) OVER (
    PARTITION BY shipment_id ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'LABEL_CREATED')
    AS status_after
  FROM outcomes WHERE stored""")

# --- failures ------------------------------------------------------------------------------------
# a failure delivered in both batches updates its row twice
add_a("failed_events_upsert", """SELECT failed.* EXCLUDE (version), version + again AS version FROM failed JOIN (
  SELECT event_id, count(*) FILTER (arrival > floor(cut / 2) AND arrival <= cut) AS again
  FROM failures, middle GROUP BY event_id) USING (event_id)""", "failures", "failed", "middle")
add_a("dead_letters", """SELECT CAST(shipment_id AS VARCHAR) AS "key", payload AS "value", topic AS original_topic,
  part AS original_partition, off AS original_offset, error_category, error_type AS exception_type,
  error_message AS exception_message, failed_at AS dead_lettered_at FROM failures""", "failures")
add_a("retry_schedule", """SELECT event_id, arrival, attempt, wait_ms, failed_at + INTERVAL 1 MILLISECOND * elapsed AS due_at
  FROM failures, (VALUES (1, 200, 200), (2, 400, 600), (3, 800, 1400), (4, 1600, 3000), (5, 2000, 5000))
    AS w(attempt, wait_ms, elapsed)
  WHERE error_category = 'SHIPMENT_NOT_FOUND'""", "failures")
add_a("replay_eligible", """SELECT failed_event_id, event_id, shipment_id, error_category, retry_count, status
  FROM failed WHERE error_category IN (SELECT error_category FROM categories WHERE manual_retry)""",
      "failures", "failed", "categories")
add_a("replay_result", """SELECT f.failed_event_id, f.event_id,
  CASE WHEN replayed AND again IS NOT NULL THEN again ELSE f.error_category END AS error_category,
  CASE WHEN replayed AND again = 'CARRIER_MISMATCH' THEN 'CarrierMismatchException'
       WHEN replayed AND again = 'UNSUPPORTED_CARRIER' THEN 'UnsupportedCarrierException'
       WHEN replayed AND again = 'UNKNOWN_EVENT_TYPE' THEN 'UnknownCarrierEventTypeException'
       ELSE f.error_type END AS error_type,
  CASE WHEN replayed AND again = 'CARRIER_MISMATCH' THEN concat('Shipment ', f.shipment_id, ' is registered with carrier ',
            registered, ' but the event claims ', claimed)
       WHEN replayed AND again = 'UNSUPPORTED_CARRIER' THEN concat('No event normalizer is registered for carrier ', claimed)
       WHEN replayed AND again = 'UNKNOWN_EVENT_TYPE' THEN concat('Carrier ', claimed, ' sent unrecognised event type ''', code, '''')
       ELSE f.error_message END AS error_message,
  CAST(CASE WHEN replayed AND again IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS retry_count,
  CASE WHEN replayed AND again IS NULL THEN 'RESOLVED' ELSE 'FAILED' END AS status,
  f.version + CASE WHEN replayed THEN 1 ELSE 0 END AS version
  FROM failed f JOIN (
    SELECT o.event_id, any_value(o.carrier_code) AS claimed, any_value(o.event_type) AS code,
      any_value(c.carrier_code) AS registered,
      any_value(f2.error_category IN (SELECT error_category FROM categories WHERE manual_retry)) AS replayed,
      any_value(CASE WHEN c.carrier_code IS NULL THEN 'SHIPMENT_NOT_FOUND'
        WHEN c.carrier_code <> o.carrier_code THEN 'CARRIER_MISMATCH'
        WHEN NOT o.supported THEN 'UNSUPPORTED_CARRIER'
        WHEN o.normalized_event_type IS NULL THEN 'UNKNOWN_EVENT_TYPE' END) AS again
    FROM outcomes o JOIN failed f2 ON f2.event_id = o.event_id LEFT JOIN customers c ON c.shipment_id = o.shipment_id
    WHERE o.error_category IS NOT NULL GROUP BY o.event_id) r ON r.event_id = f.event_id""",
      "failures", "failed", "categories")

# --- commands ------------------------------------------------------------------------------------
_R = ["customers", "shipments", "requests"]
add("register_shipments", """SELECT uuid_of(concat(carrier_code, '|', tracking_number)) AS shipment_id, request_id, retailer_id,
  customer_id, tracking_number, carrier_code, 'LABEL_CREATED' AS current_status, estimated_delivery_date,
  CAST(0 AS BIGINT) AS version, requested_at AS created_at
  FROM numbered WHERE problem IS NULL AND rn = 1 AND NOT taken""", *_R)
add("register_rejected", """SELECT request_id, carrier_code, tracking_number,
  CASE WHEN problem IS NOT NULL THEN 'INVALID' ELSE 'DUPLICATE' END AS reason,
  coalesce(problem, concat('Shipment already exists for carrier ', carrier_code, ' and tracking number ',
    tracking_number)) AS detail
  FROM numbered WHERE problem IS NOT NULL OR rn > 1 OR taken""", *_R)
add("revise_estimates", """SELECT s.shipment_id,
  coalesce(CAST(CAST(r.o_orderdate AS DATE) + 5 AS DATE), s.estimated_delivery_date) AS estimated_delivery_date,
  s.created_at, coalesce(r.o_orderdate, s.updated_at) AS updated_at
  FROM shipments s LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) r
  ON r.o_custkey = s.shipment_id AND r.rn = 1""", "customers", "shipments")


# --- pages and lookups ---------------------------------------------------------------------------
def _page(source: str, by: str, columns: str, order: str, page: int, size: int) -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {columns}, CAST({page} AS INTEGER) AS page, CAST({size} AS INTEGER) AS size, total_elements,
  CAST(ceil(total_elements / {size}.0) AS BIGINT) AS total_pages, {page} + 1 < ceil(total_elements / {size}.0) AS has_next
  FROM (SELECT *, CAST(row_number() OVER ({part} ORDER BY {order}) AS INTEGER) AS "position",
    count(*) OVER ({part}) AS total_elements FROM {source})
  WHERE "position" > {page * size} AND "position" <= {(page + 1) * size}"""


_VIEW = """event_id, normalized_event_type, carrier_event_type, carrier_code, event_time, received_at,
  sequence_number, location, description, processing_status, correlation_id"""
add_a("history_page", _page("history", "shipment_id", f'shipment_id, {_VIEW}, "position"',
                            "event_time, sequence_number, event_id", 1, 15), "history")
add_a("notifications_page", _page(
    "notifications", "shipment_id",
    'shipment_id, notification_id, source_event_id, notification_type, channel, status, created_at, "position"',
    "created_at, notification_id", 0, 10), "rules", "notifications")
add_a("retailer_page", _page(
    "state", "retailer_id", """retailer_id, shipment_id, tracking_number, carrier_code, current_status,
  estimated_delivery_date, last_event_time, version, created_at, updated_at, "position\"""",
    "created_at DESC, shipment_id", 0, 20), "state")
add_a("retailer_status_page", _page(
    "(SELECT * FROM state WHERE current_status = 'LABEL_CREATED') q", "retailer_id",
    """retailer_id, shipment_id, tracking_number, carrier_code, current_status,
  estimated_delivery_date, last_event_time, version, created_at, updated_at, "position\"""",
    "created_at DESC, shipment_id", 1, 7), "state")
add_a("failed_events_page", _page(
    "(SELECT * FROM failed JOIN categories USING (error_category)) q", "",
    """failed_event_id, event_id, shipment_id, error_category, auto_retry AS retryable_automatically,
  manual_retry AS retryable_manually, error_type, error_message, retry_count, status, original_topic,
  original_partition, original_offset, first_failed_at, last_failed_at""",
    "last_failed_at DESC, failed_event_id", 1, 100), "failures", "failed", "categories")
def _after(name: str, page: int) -> None:
    """The SQL of a page, without its number: it was reached from the page before. Of groups that have one."""
    ORACLE[name] = ORACLE[name].replace(f"CAST({page} AS INTEGER) AS page, ", "").replace(
        ORACLE[name][ORACLE[name].index("  CAST(ceil(total"):ORACLE[name].index(f"{page} + 1 <")], "  ")


for _name, _size, _from in (("history", 15, 2), ("notifications", 5, 1), ("retailer", 3, 1)):
    _sql = {"history": ("history", "shipment_id", f'shipment_id, {_VIEW}, "position"', "event_time, sequence_number, event_id"),
            "notifications": ("notifications", "shipment_id", """shipment_id, notification_id, source_event_id,
  notification_type, channel, status, created_at, "position\"""", "created_at, notification_id"),
            "retailer": ("state", "retailer_id", """retailer_id, shipment_id, tracking_number, carrier_code, current_status,
  estimated_delivery_date, last_event_time, version, created_at, updated_at, "position\"""", "created_at DESC, shipment_id")}[_name]
    add_a(f"{_name}_page_after", _page(*_sql, _from, _size),
          *{"history": ["history"], "notifications": ["rules", "notifications"], "retailer": ["state"]}[_name])
    _after(f"{_name}_page_after", _from)
add_a("failed_events_page_after", _page(
    "(SELECT * FROM failed JOIN categories USING (error_category)) q", "",
    """failed_event_id, event_id, shipment_id, error_category, auto_retry AS retryable_automatically,
  manual_retry AS retryable_manually, error_type, error_message, retry_count, status, original_topic,
  original_partition, original_offset, first_failed_at, last_failed_at, "position\"""",
    "last_failed_at DESC, failed_event_id", 2, 20), "failures", "failed", "categories")
_after("failed_events_page_after", 2)
add_a("shipment_look_up", """SELECT i.shipment_id, retailer_id, tracking_number, carrier_code, current_status,
  estimated_delivery_date, last_event_time, version, created_at, updated_at, retailer_id IS NOT NULL AS found
  FROM (SELECT DISTINCT shipment_id FROM feed) i LEFT JOIN state USING (shipment_id)""", "state")
add_a("failed_event_look_up", """SELECT i.event_id, failed_event_id, shipment_id, error_category,
  auto_retry AS retryable_automatically, manual_retry AS retryable_manually, error_type, error_message, retry_count,
  status, original_topic, original_partition, original_offset, first_failed_at, last_failed_at,
  failed_event_id IS NOT NULL AS found
  FROM (SELECT DISTINCT event_id FROM feed) i LEFT JOIN failed USING (event_id) LEFT JOIN categories USING (error_category)""",
      "failures", "failed", "categories")
add_a("history_by_tracking_number", f"SELECT tracking_number, {_VIEW} FROM history", "history")
add_a("recent_ingest", """SELECT received_at, event_id, shipment_id, carrier_event_type, processing_status FROM history
  ORDER BY received_at DESC, event_id LIMIT 100""", "history")

# --- reports -------------------------------------------------------------------------------------
_COUNTS = ", ".join(f"{sql} AS {name}" for name, sql in _METRICS.items())
add_a("outcome_counts", f"SELECT {_COUNTS} FROM outcomes")
add_a("attempt_counts", """SELECT CAST(sum(tries) AS BIGINT) AS received, count(*) FILTER (error_category IS NULL) AS processed,
  CAST(sum(tries) FILTER (error_category IS NOT NULL) AS BIGINT) AS failed,
  count(*) FILTER (error_category IS NOT NULL) AS dead_lettered
  FROM (SELECT *, CASE WHEN error_category = 'SHIPMENT_NOT_FOUND' THEN 6 ELSE 1 END AS tries FROM outcomes)""")
add_a("failures_by_category", """SELECT error_category, auto_retry AS retryable,
  (SELECT count(*) FROM outcomes o WHERE o.error_category = categories.error_category) AS failures FROM categories""",
      "categories")
add_a("notification_counts", """SELECT notification_type, (SELECT count(*) FROM notifications n
  WHERE n.notification_type = rules.notification_type) AS notifications FROM rules""", "rules", "notifications")
add_a("notification_skips", """SELECT reason, (SELECT count(*) FROM outcomes WHERE applied AND
    CASE WHEN normalized_event_type NOT IN (SELECT notification_type FROM rules) THEN reason = 'not_notifiable'
      ELSE reason = 'already_exists' AND arrival <= (SELECT cut FROM middle) END) AS skipped
  FROM (VALUES ('not_notifiable'), ('already_exists')) AS r(reason)""", "rules", "middle")
add_a("backlog_gauges", """SELECT 'shipments_active' AS gauge, count(*) AS value FROM state WHERE current_status <> 'DELIVERED'
  UNION ALL SELECT 'failed_events_awaiting_review', count(*) FROM failed WHERE status = 'FAILED'
  UNION ALL SELECT 'dead_letters_unresolved', count(*) FROM failed WHERE status <> 'RESOLVED'""",
      "state", "failures", "failed")
add_a("status_distribution", "SELECT current_status, count(*) AS shipments FROM state GROUP BY current_status", "state")
add_a("version_invariant", """SELECT shipment_id, version, coalesce(n, 0) AS stored_events,
  coalesce(a, 0) AS applied_events, version = coalesce(a, 0) AS holds
  FROM state LEFT JOIN (SELECT shipment_id, count(*) AS n, count(*) FILTER (processing_status = 'APPLIED') AS a
    FROM history GROUP BY shipment_id) USING (shipment_id)""", "history", "state")

_EDGES = [3600.0, 21600.0, 43200.0, 86400.0, 172800.0, 432000.0, 864000.0, 1296000.0, 1728000.0, 2160000.0, 2419200.0]
CTE["edges"] = "edges(le, up) AS (VALUES " + ", ".join(
    f"(CAST({e} AS DOUBLE), CAST({e} AS DOUBLE))" for e in _EDGES) + ", (NULL, CAST('inf' AS DOUBLE)))"
_LAG = "(epoch_us(received_at) - epoch_us(event_time)) / 1000000.0"
CTE["histogram"] = f"""lags AS (SELECT processing_status, CAST({_LAG} AS DOUBLE) AS lag FROM history),
histogram AS (SELECT processing_status, le, up, count(*) FILTER (lag <= up) AS cumulative
  FROM lags CROSS JOIN edges GROUP BY processing_status, le, up)"""
add_a("lag_histogram", "SELECT processing_status, le, cumulative FROM histogram", "history", "edges", "histogram")


def _quantile(by: str, q: str = "q") -> str:
    """Rank, first bucket reaching it, linear position inside."""
    return f"""SELECT {by}, q AS quantile,
    CASE WHEN le IS NULL THEN lo ELSE lo + (le - lo) * ((q * total - below) / (cumulative - below)) END AS seconds
  FROM (SELECT *, row_number() OVER (PARTITION BY {by}, q ORDER BY up) AS rn FROM (
    SELECT *, coalesce(lag(le) OVER (PARTITION BY {by}, q ORDER BY up), 0.0) AS lo,
      coalesce(lag(cumulative) OVER (PARTITION BY {by}, q ORDER BY up), 0) AS below,
      max(cumulative) OVER (PARTITION BY {by}, q) AS total
    FROM {{source}} CROSS JOIN {{quantiles}}) WHERE total > 0 AND cumulative >= q * total) WHERE rn = 1"""


add_a("lag_quantiles", _quantile("processing_status").format(
    source="histogram", quantiles="(VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE)), (CAST(0.99 AS DOUBLE))) AS v(q)"),
      "history", "edges", "histogram")
add_a("duration_histogram", f"""SELECT r.outcome, le, count(*) FILTER (lag <= up) AS cumulative
  FROM (VALUES ('APPLIED'), ('OUT_OF_ORDER'), ('DUPLICATE'), ('FAILED')) AS r(outcome) CROSS JOIN edges LEFT JOIN (
    SELECT CASE WHEN error_category IS NOT NULL THEN 'FAILED' WHEN outcome = 'SUPERSEDED' THEN 'OUT_OF_ORDER' ELSE outcome END
      AS outcome, CAST({_LAG} AS DOUBLE) AS lag FROM outcomes) d USING (outcome) GROUP BY r.outcome, le""", "edges")
add("partition_lag", """SELECT topic, "partition", end_offset, lag, max(lag) OVER (PARTITION BY topic) AS max_lag FROM (
  SELECT topic, part AS "partition", max(off) AS end_offset,
    max(off) - coalesce(max(off) FILTER (arrival <= (SELECT cut FROM middle)), 0) AS lag
  FROM feed GROUP BY topic, part)""", "feed", "middle")
add_a("reconciliation", """SELECT line, expected, actual, CASE WHEN expected IS NULL OR actual IS NULL THEN 'N/A'
    WHEN expected = actual THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM (
  SELECT 'published_received' AS line, (SELECT count(*) FROM feed) AS expected, (SELECT count(*) FROM outcomes) AS actual
  UNION ALL SELECT 'duplicates_detected', (SELECT count(*) - count(DISTINCT event_id) FROM feed),
    (SELECT count(*) FROM outcomes WHERE outcome = 'DUPLICATE')
  UNION ALL SELECT 'out_of_order_detected', NULL, (SELECT count(*) FROM outcomes WHERE outcome = 'SUPERSEDED')
  UNION ALL SELECT 'stored', (SELECT count(DISTINCT event_id) FROM feed), (SELECT count(*) FROM history)
  UNION ALL SELECT 'failed_dead_lettered', (SELECT count(*) FROM outcomes WHERE error_category IS NOT NULL),
    (SELECT count(*) FROM failed))""", "history", "failures", "failed")
add_a("reconciliation_dead_letters", """SELECT line, expected, actual, CASE WHEN expected IS NULL OR actual IS NULL THEN 'N/A'
    WHEN expected = actual THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM (
  SELECT 'published_received' AS line, (SELECT count(*) FROM feed) AS expected, (SELECT count(*) FROM outcomes) AS actual
  UNION ALL SELECT 'duplicates_detected', (SELECT count(*) - count(DISTINCT event_id) FROM feed),
    (SELECT count(*) FROM outcomes WHERE outcome = 'DUPLICATE')
  UNION ALL SELECT 'out_of_order_detected', NULL, (SELECT count(*) FROM outcomes WHERE outcome = 'SUPERSEDED')
  UNION ALL SELECT 'stored', (SELECT count(DISTINCT event_id) FROM feed), (SELECT count(*) FROM history)
  UNION ALL SELECT 'failed_dead_lettered', (SELECT count(*) FROM outcomes WHERE error_category IS NOT NULL),
    (SELECT count(*) FROM failures)
  UNION ALL SELECT 'failed_events', (SELECT count(DISTINCT event_id) FROM outcomes WHERE error_category IS NOT NULL),
    (SELECT count(*) FROM failed))""", "history", "failures", "failed")
add_a("reconcile_except", """SELECT DISTINCT event_id, 'not_stored' AS side FROM feed
  WHERE event_id NOT IN (SELECT event_id FROM history)""", "history")
add_a("counter_deltas", "SELECT metric, b AS before, a AS after, a - b AS delta, (a - b) / (n / 2.0::DOUBLE) AS per_second FROM ("
      + " UNION ALL ".join(
          f"SELECT '{name}' AS metric, {sql} AS a, {sql.replace('FILTER (', 'FILTER (arrival <= cut AND ') if 'FILTER' in sql else 'count(*) FILTER (arrival <= cut)'} AS b, "
          "CAST(count(*) AS DOUBLE) AS n FROM outcomes, middle" for name, sql in _METRICS.items()) + ")", "middle")

# --- rates and alerts ----------------------------------------------------------------------------
_W300 = "make_timestamp((epoch_us(received_at) // 300000000) * 300000000) AS window_start"
CTE["rates"] = f"rates AS (SELECT {_W300}, " + ", ".join(
    f"{sql} / CAST(300 AS DOUBLE) AS {name}_rate" for name, sql in _METRICS.items()) + " FROM outcomes GROUP BY 1)"
add_a("event_rates", "SELECT * FROM rates", "rates")
add_a("failure_rates", f"""SELECT {_W300}, error_category, count(*) / CAST(300 AS DOUBLE) AS rate FROM outcomes
  WHERE error_category IS NOT NULL GROUP BY 1, 2""")
add_a("rates_by_carrier", f"""SELECT {_W300}, carrier_code, outcome, count(*) AS deliveries,
  count(*) / CAST(300 AS DOUBLE) AS rate FROM outcomes GROUP BY 1, 2, 3""")
add_a("failure_ratio", """SELECT window_start, failed_rate, received_rate,
  failed_rate / greatest(received_rate, CAST(0.001 AS DOUBLE)) AS failure_ratio FROM rates""", "rates")

CTE["ends"] = """spans AS (SELECT min(epoch_us(received_at) // 60000000) + 1 AS lo, max(epoch_us(received_at) // 60000000) + 1 AS hi
  FROM outcomes),
per_minute AS (SELECT epoch_us(received_at) // 60000000 + 1 AS minute, count(*) AS received,
  count(*) FILTER (error_category IS NOT NULL) AS failed, max(off) AS produced FROM outcomes GROUP BY 1),
ends AS (SELECT unnest(range(lo, hi + {extra} + 1)) AS minute FROM spans)"""


def _ends(extra: int) -> str:
    CTE[f"ends{extra}"] = CTE["ends"].replace("{extra}", str(extra))
    return f"ends{extra}"


def _sum(metric: str, minutes: int) -> str:
    return (f"coalesce((SELECT sum({metric}) FROM per_minute p WHERE p.minute > e.minute - {minutes} "
            f"AND p.minute <= e.minute), 0)")


_END = "make_timestamp(e.minute * 60000000)"
add_a("rates_sliding", f"""SELECT {_END} AS window_end, {_sum('received', 10)} / CAST(600 AS DOUBLE) AS received_rate,
  {_sum('failed', 10)} / CAST(600 AS DOUBLE) AS failed_rate, {_sum('failed', 10)} / CAST(600 AS DOUBLE) AS dead_lettered_rate
  FROM ends e WHERE {_sum('received', 10)} > 0""", _ends(9))

add_a("notification_rates", """SELECT make_timestamp((epoch_us(created_at) // 300000000) * 300000000) AS window_start,
  notification_type, count(*) / CAST(300 AS DOUBLE) AS rate FROM notifications GROUP BY 1, 2""", "rules", "notifications")
add_a("notification_skip_rates", f"""SELECT {_W300}, reason, count(*) / CAST(300 AS DOUBLE) AS rate FROM (
  SELECT received_at, CASE WHEN normalized_event_type NOT IN (SELECT notification_type FROM rules) THEN 'not_notifiable'
    WHEN arrival <= (SELECT cut FROM middle) THEN 'already_exists' END AS reason FROM outcomes WHERE applied)
  WHERE reason IS NOT NULL GROUP BY 1, 2""", "rules", "middle")

_HELD = """count(*) FILTER (holds) OVER (PARTITION BY rule ORDER BY minute
    RANGE BETWEEN {hold} PRECEDING AND CURRENT ROW)"""
add_a("silence", f"""SELECT window_end, received, silent, silent AND since >= 31 AS firing FROM (
  SELECT *, count(*) FILTER (silent) OVER (ORDER BY minute ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS since FROM (
    SELECT e.minute, {_END} AS window_end, CAST({_sum('received', 15)} AS BIGINT) AS received,
      {_sum('received', 15)} = 0 AS silent FROM ends e))""", _ends(60))

_R5, _F5 = f"({_sum('received', 5)} / CAST(300 AS DOUBLE))", f"({_sum('failed', 5)} / CAST(300 AS DOUBLE))"
CTE["alert_values"] = f"""lag_steps AS (
  SELECT epoch_us(received_at) // 60000000 + 1 AS minute, le, up,
    count(*) FILTER (CAST({_LAG} AS DOUBLE) <= up) AS c
  FROM outcomes CROSS JOIN edges WHERE stored GROUP BY 1, 2, 3),
lag_windows AS (
  SELECT e.minute, le, up, CAST(sum(c) AS BIGINT) AS cumulative FROM ends e JOIN lag_steps s
    ON s.minute > e.minute - 5 AND s.minute <= e.minute GROUP BY 1, 2, 3),
quantile_windows AS (SELECT * FROM lag_windows),
latency AS ({_quantile('minute').format(source='lag_windows', quantiles='(VALUES (CAST(0.99 AS DOUBLE))) AS v(q)')}),
alert_values AS (
  SELECT 'EventProcessingFailureRateHigh' AS rule, minute, {_F5} / greatest({_R5}, CAST(0.001 AS DOUBLE)) AS value,
    5 AS hold, CAST(0.05 AS DOUBLE) AS threshold FROM ends e
  UNION ALL SELECT 'DeadLetterRateElevated', minute, {_sum('failed', 10)} / CAST(600 AS DOUBLE), 10, 0 FROM ends e
  UNION ALL SELECT 'EventProcessingLatencyHigh', e.minute, l.seconds, 10, 1296000
    FROM ends e LEFT JOIN latency l ON l.minute = e.minute
  UNION ALL SELECT 'ConsumerLagGrowing', e.minute, CASE WHEN m.minute IS NOT NULL THEN CAST(
      (SELECT max(produced) FROM per_minute p WHERE p.minute <= e.minute)
      - coalesce((SELECT max(produced) FROM per_minute p WHERE p.minute <= e.minute - 25), 0) AS DOUBLE) END, 10, 1000
    FROM ends e LEFT JOIN per_minute m ON m.minute = e.minute
  UNION ALL SELECT 'FailedEventsAwaitingReview', e.minute, CASE WHEN m.minute IS NOT NULL THEN CAST(
      (SELECT sum(failed) FROM per_minute p WHERE p.minute <= e.minute) AS DOUBLE) END, 15, 20
    FROM ends e LEFT JOIN per_minute m ON m.minute = e.minute
  UNION ALL SELECT 'NoEventsReceived', minute, {_sum('received', 15)} / CAST(900 AS DOUBLE), 30, NULL FROM ends e)"""
CTE["lag_windows"] = CTE["alert_values"][:CTE["alert_values"].index(",\nquantile_windows")]
add_a("lag_quantiles_by_window", "SELECT make_timestamp(minute * 60000000) AS window_end, quantile, seconds FROM ("
      + _quantile("minute").format(source="lag_windows", quantiles="(VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE)), "
                                   "(CAST(0.99 AS DOUBLE))) AS v(q)") + ")", "edges", _ends(60), "lag_windows")
add_a("alerts", """SELECT rule, make_timestamp(minute * 60000000) AS window_end, CAST(value AS DOUBLE) AS value,
  holds AND since = hold + 1 AS firing FROM (
  SELECT a.*, (SELECT count(*) FROM held b WHERE b.rule = a.rule AND b.holds AND b.minute BETWEEN a.minute - a.hold AND a.minute)
    AS since FROM held a)""".replace("held", "conditions"), "edges", _ends(60), "alert_values", )
ORACLE["alerts"] = ORACLE["alerts"].replace("SELECT rule, make_timestamp(minute", """, conditions AS (
  SELECT *, coalesce(CASE WHEN rule = 'NoEventsReceived' THEN value = 0 ELSE value > threshold END, FALSE) AS holds
  FROM alert_values)
SELECT rule, make_timestamp(minute""", 1)

# --- volume --------------------------------------------------------------------------------------
_B = ["feed_b", "outcomes_b"]
add("outcome_stream_volume", """SELECT event_id, shipment_id, off AS "offset", event_time, sequence_number,
  normalized_event_type, outcome, received_at FROM outcomes""", *_B)
add("current_state_volume", "SELECT * FROM state", *_B, "shipments_b", "state")
add("status_distribution_volume", "SELECT current_status, count(*) AS shipments FROM state GROUP BY 1",
    *_B, "shipments_b", "state")
add("notifications_volume", f"SELECT {_NOTE} FROM notifications", *_B, "rules", "notifications")
add("outcome_counts_volume", f"SELECT {_COUNTS} FROM outcomes", *_B)

# surrogate ids are digests in UUID form
_UUID_OF = re.compile(r"uuid_of\(((?:[^()]|\([^()]*\))*)\)")
for _name, _sql in ORACLE.items():
    ORACLE[_name] = _UUID_OF.sub(
        r"regexp_replace(md5(\1), '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5')", _sql)
