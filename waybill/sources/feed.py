"""The carrier feed: reading it, decoding it, flattening publish requests into it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import model as M

# Syntax of ids and instants on the wire
_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_INSTANT = r"^[+-]?\d{4,}-\d\d-\d\dT\d\d:\d\d(:\d\d([.]\d{1,9})?)?(Z|[+-]\d\d(:?\d\d)?)$"


def read_feed(spark: SparkSession, source: str, *, topic: str | None = None, stream: bool = False,
              max_files_per_trigger: int | None = None, max_offsets_per_trigger: int | None = None,
              offsets: dict[int, tuple[int | None, int | None]] | None = None) -> DataFrame:
    """The feed with key, value, topic, partition, offset and timestamp, from its beginning.

    ``offsets`` limits the read: for each partition the first offset and the one to stop before, either
    may be None; partitions not named are left out. On files that is a filter Parquet takes down to its
    row groups; a broker starts there, and a batch ends there (a stream has no end).

    ``source`` is a folder of Parquet files in that shape, or with ``topic`` the broker addresses
    of a Kafka cluster (needs the spark-sql-kafka package on the class path). The timestamp is
    taken for the time of reception, so the topic should stamp records on append.
    """
    reader = spark.readStream if stream else spark.read
    if topic is None:
        reader = reader.schema(M.FEED_SCHEMA)
        if stream and max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return _within(reader.parquet(source), offsets)
    reader = (reader.format("kafka").option("kafka.bootstrap.servers", source)
              .options(**_broker_range(topic, offsets, stream)))
    if stream and max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp")


def _within(feed: DataFrame, offsets) -> DataFrame:
    if offsets is None:
        return feed
    chosen = F.lit(False)
    for number, (first, end) in offsets.items():
        here = F.col("partition") == number
        if first is not None:
            here = here & (F.col("offset") >= first)
        if end is not None:
            here = here & (F.col("offset") < end)
        chosen = chosen | here
    return feed.where(chosen)


def _broker_range(topic: str, offsets, stream: bool) -> dict[str, str]:
    """Options of the broker's reader. Fixed values: -2 is the earliest offset, -1 the latest."""
    if offsets is None:
        return {"subscribe": topic, "startingOffsets": "earliest"}
    limits = {"assign": json.dumps({topic: sorted(offsets)}),
              "startingOffsets": json.dumps({topic: {str(p): -2 if a is None else a for p, (a, _) in offsets.items()}})}
    if not stream:
        limits["endingOffsets"] = json.dumps({topic: {str(p): -1 if b is None else b for p, (_, b) in offsets.items()}})
    return limits


def parse_feed(feed: DataFrame, key_type: str = "string", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decodes the JSON values; rows that do not decode stay, flagged ``malformed``. Columns ``keep`` stay.

    Arrival is the broker's order: topic, partition, offset. The timestamp is the time of reception only.

    All fields are read as text and then cast, so a number in quotes is accepted and any value
    that does not fit its type makes the row malformed. So does a carrier outside the closed set.
    A missing body (NULL, or JSON null) is not malformed: validation reports it. ``key_type`` is
    ``string`` for UUID keys, or a numeric type.
    """
    wire = T.StructType([T.StructField(w, T.StringType()) for _, w in M.WIRE_NAMES]
                        + [T.StructField("_corrupt_record", T.StringType())])
    body = F.when(F.col("value").rlike(r"^\s*\{"), F.from_json(
        "value", wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    opened = feed.withColumn("_body", body).withColumn(
        "payload_missing", F.col("value").isNull() | F.col("value").rlike(r"^\s*null\s*$"))

    columns, misfits = [], []
    for name, wire_name in M.WIRE_NAMES:
        text = F.col("_body")[wire_name]
        typed = _typed(name, text, key_type)
        if typed is not None:
            misfits.append(text.isNotNull() & typed.isNull())
        columns.append((text if typed is None else typed).alias(name))
    bad = F.col("_body").isNull() | F.col("_body._corrupt_record").isNotNull()
    for misfit in misfits:
        bad = bad | misfit
    decoded = opened.withColumn("malformed", ~F.col("payload_missing") & bad)
    return decoded.select(
        # an undecodable row has no fields, also none that happened to be readable
        *[F.when(~F.col("malformed"), c).alias(name) for c, (name, _) in zip(columns, M.WIRE_NAMES)],
        "payload_missing", "malformed", F.col("value").alias("payload"),
        F.struct("topic", "partition", "offset").alias("arrival"),
        F.col("timestamp").alias("received_at"), "topic", "partition", "offset", *keep)


def _typed(name: str, text, key_type: str):
    if name in ("event_id", "shipment_id"):
        return F.when(text.rlike(_UUID), F.lower(text)) if key_type == "string" else text.try_cast(key_type)
    if name == "schema_version":
        return text.try_cast("int")
    if name == "sequence_number":
        return text.try_cast("long")
    if name == "event_time":
        return F.when(text.rlike(_INSTANT), text.try_cast("timestamp"))
    if name == "carrier_code":
        return F.when(text.isin(*M.CARRIERS), text)
    return None


def flatten_batches(documents: DataFrame) -> DataFrame:
    """Publish requests to feed records: a document is one event or an array of them.

    Each element keeps its own JSON text (fields this code does not know included) and is keyed by
    its shipment. ``position`` keeps the order within the request.
    """
    elements = F.when(F.col("document").rlike(r"^\s*\["), F.from_json("document", "array<string>")).otherwise(
        F.array("document"))
    return (documents.select("request_id", F.posexplode(elements).alias("position", "value"))
            .withColumn("key", F.get_json_object("value", "$.shipmentId")))
