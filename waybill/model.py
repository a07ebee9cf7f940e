"""Table schemas and closed vocabularies.

The vocabularies are inline ``VALUES`` relations: Catalyst knows their exact size, so joins with
them are planned as broadcast joins from statistics, without a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- Fixed values: statuses, carriers, codes, categories, texts -----------------------------

STATUSES = (
    "LABEL_CREATED", "PICKED_UP", "IN_TRANSIT", "ARRIVED_AT_FACILITY",
    "OUT_FOR_DELIVERY", "DELAYED", "DELIVERY_ATTEMPTED", "DELIVERED",
)
INITIAL_STATUS = "LABEL_CREATED"
TERMINAL_STATUS = "DELIVERED"

CARRIERS = ("SWIFTPOST", "NORDEX", "PACIFICA", "METROLINK")

# (carrier, carrier code, status)
VOCABULARY = (
    ("SWIFTPOST", "SP_CREATED", "LABEL_CREATED"),
    ("SWIFTPOST", "SP_PICKUP", "PICKED_UP"),
    ("SWIFTPOST", "SP_TRANSIT", "IN_TRANSIT"),
    ("SWIFTPOST", "SP_DEPOT", "ARRIVED_AT_FACILITY"),
    ("SWIFTPOST", "SP_OFD", "OUT_FOR_DELIVERY"),
    ("SWIFTPOST", "SP_DELAY", "DELAYED"),
    ("SWIFTPOST", "SP_ATTEMPT", "DELIVERY_ATTEMPTED"),
    ("SWIFTPOST", "SP_DELIVERED", "DELIVERED"),
    ("PACIFICA", "MANIFESTED", "LABEL_CREATED"),
    ("PACIFICA", "COLLECTED", "PICKED_UP"),
    ("PACIFICA", "MOVING", "IN_TRANSIT"),
    ("PACIFICA", "AT_TERMINAL", "ARRIVED_AT_FACILITY"),
    ("PACIFICA", "COURIER_ROUTE", "OUT_FOR_DELIVERY"),
    ("PACIFICA", "EXCEPTION_DELAY", "DELAYED"),
    ("PACIFICA", "DELIVERY_FAILED", "DELIVERY_ATTEMPTED"),
    ("PACIFICA", "COMPLETE", "DELIVERED"),
)

NOTIFIABLE = ("PICKED_UP", "OUT_FOR_DELIVERY", "DELAYED", "DELIVERY_ATTEMPTED", "DELIVERED")
NOTIFICATION_CHANNEL = "EMAIL"
NOTIFICATION_STATUS = "PENDING"
SKIP_REASONS = ("not_notifiable", "already_exists")

# (category, retried automatically, retried on request)
ERROR_CATEGORIES = (
    ("MALFORMED_PAYLOAD", False, False),
    ("VALIDATION", False, False),
    ("UNKNOWN_EVENT_TYPE", False, False),
    ("CARRIER_MISMATCH", False, False),
    ("UNSUPPORTED_CARRIER", False, True),
    ("SHIPMENT_NOT_FOUND", True, True),
    ("CONCURRENCY_CONFLICT", True, True),
    ("INFRASTRUCTURE", True, True),
    ("UNKNOWN", False, True),
)

# error type reported per category
ERROR_TYPES = (
    ("MALFORMED_PAYLOAD", "DeserializationException"),
    ("VALIDATION", "InvalidCarrierEventException"),
    ("SHIPMENT_NOT_FOUND", "ShipmentNotFoundException"),
    ("CARRIER_MISMATCH", "CarrierMismatchException"),
    ("UNSUPPORTED_CARRIER", "UnsupportedCarrierException"),
    ("UNKNOWN_EVENT_TYPE", "UnknownCarrierEventTypeException"),
)

RESULTS = ("APPLIED", "OUT_OF_ORDER", "DUPLICATE", "FAILED")

SUPPORTED_SCHEMA_VERSION = 1
MAX_LENGTHS = (
    ("tracking_number", 128), ("event_type", 64), ("location", 255),
    ("description", 512), ("correlation_id", 64),
)
MAX_ERROR_MESSAGE = 2000
MAX_ERROR_TYPE = 255

TEXT_MISSING = "Event payload is missing"
TEXT_VERSION = "Unsupported schema version %s; this service understands version %d"
TEXT_INVALID = "Event failed validation: "
TEXT_NOT_NULL = "must not be null"
TEXT_NOT_BLANK = "must not be blank"
TEXT_POSITIVE = "must be greater than 0"
TEXT_SIZE = "size must be between 0 and %d"
TEXT_NOT_FOUND = "Shipment %s not found"
TEXT_MISMATCH = "Shipment %s is registered with carrier %s but the event claims %s"
TEXT_UNSUPPORTED = "No event normalizer is registered for carrier %s"
TEXT_UNKNOWN_CODE = "Carrier %s sent unrecognised event type '%s'"
TEXT_DUPLICATE_SHIPMENT = "Shipment already exists for carrier %s and tracking number %s"

RETRY_INITIAL_MS, RETRY_MULTIPLIER, RETRY_MAX_MS, RETRY_LIMIT = 200, 2.0, 2000, 5
PAGE_LIMITS = (("retailer", 100), ("failed", 100), ("notifications", 100), ("history", 200))

# column name -> name on the wire
WIRE_NAMES = (
    ("event_id", "eventId"), ("schema_version", "schemaVersion"), ("shipment_id", "shipmentId"),
    ("tracking_number", "trackingNumber"), ("carrier_code", "carrierCode"),
    ("event_type", "eventType"), ("event_time", "eventTime"),
    ("sequence_number", "sequenceNumber"), ("location", "location"),
    ("description", "description"), ("correlation_id", "correlationId"),
)

# --- Schemas ---------------------------------------------------------------------------------

FEED_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def shipments_schema(key: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("shipment_id", key),
        T.StructField("retailer_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("tracking_number", T.StringType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("current_status", T.StringType()),
        T.StructField("estimated_delivery_date", T.DateType()),
        T.StructField("last_event_time", T.TimestampType()),
        T.StructField("last_sequence_number", T.LongType()),
        T.StructField("last_received_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ])


def history_schema(key: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("event_id", key),
        T.StructField("shipment_id", key),
        T.StructField("tracking_number", T.StringType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("carrier_event_type", T.StringType()),
        T.StructField("normalized_event_type", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("processing_status", T.StringType()),
    ])


def notifications_schema(key: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("notification_id", T.StringType()),
        T.StructField("shipment_id", key),
        T.StructField("source_event_id", key),
        T.StructField("notification_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ])


def failed_events_schema(key: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("failed_event_id", T.StringType()),
        T.StructField("event_id", key),
        T.StructField("shipment_id", key),
        T.StructField("payload", T.StringType()),
        T.StructField("error_category", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("original_topic", T.StringType()),
        T.StructField("original_partition", T.IntegerType()),
        T.StructField("original_offset", T.LongType()),
        T.StructField("first_failed_at", T.TimestampType()),
        T.StructField("last_failed_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
    ])


# --- Vocabularies as relations ---------------------------------------------------------------


def _literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + value + "'"


def _values(spark: SparkSession, rows, columns: str) -> DataFrame:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS v({columns})")


def vocabulary(spark: SparkSession) -> DataFrame:
    return _values(spark, VOCABULARY, "carrier_code, code, status")


def error_categories(spark: SparkSession) -> DataFrame:
    return _values(spark, ERROR_CATEGORIES,
                   "error_category, retryable_automatically, retryable_manually")


def notification_rules(spark: SparkSession) -> DataFrame:
    """Status to notification type; each notifiable status names its own notification."""
    return _values(spark, [(s, s) for s in NOTIFIABLE], "status, notification_type")


def statuses(spark: SparkSession) -> DataFrame:
    return _values(spark, [(s,) for s in STATUSES], "current_status")


def processing_results(spark: SparkSession) -> DataFrame:
    return _values(spark, [(r,) for r in RESULTS], "outcome")


def skip_reasons(spark: SparkSession) -> DataFrame:
    return _values(spark, [(r,) for r in SKIP_REASONS], "reason")
