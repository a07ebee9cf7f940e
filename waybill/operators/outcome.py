"""Classification: one outcome per delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import wire_json


def _flag(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)) if name in df.columns else F.lit(False)


def add_storable(events: DataFrame) -> DataFrame:
    """Adds ``valid`` and ``storable``: everything but the redelivery check."""
    valid = ~_flag(events, "malformed") & F.col("violation").isNull()
    return events.withColumns({
        "valid": valid,
        "storable": valid & F.col("shipment_found") & F.col("carrier_matches") & F.col("carrier_supported")
        & F.col("normalized_event_type").isNotNull()})


def classify_outcome(events: DataFrame) -> DataFrame:
    """Adds ``outcome`` and ``error_category`` (NULL unless failed); the first reason wins.

    A stored row is APPLIED or SUPERSEDED once the fold has added ``applied``, STORED before.
    """
    stored = F.lit("STORED")
    if "applied" in events.columns:
        stored = F.when(F.col("applied"), F.lit("APPLIED")).otherwise(F.lit("SUPERSEDED"))
    outcome = (
        F.when(_flag(events, "malformed"), "MALFORMED_PAYLOAD")
        .when(F.col("violation").isNotNull(), "VALIDATION")
        .when(_flag(events, "is_duplicate"), "DUPLICATE")
        .when(~F.col("shipment_found"), "SHIPMENT_NOT_FOUND")
        .when(~F.col("carrier_matches"), "CARRIER_MISMATCH")
        .when(~F.col("carrier_supported"), "UNSUPPORTED_CARRIER")
        .when(F.col("normalized_event_type").isNull(), "UNKNOWN_EVENT_TYPE")
        .otherwise(stored)
    )
    return (events.withColumn("outcome", outcome)
            .withColumn("error_category", F.when(
                ~F.col("outcome").isin("STORED", "APPLIED", "SUPERSEDED", "DUPLICATE"), F.col("outcome"))))


def failures_of(outcomes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Failed deliveries with their cause in words and their origin, one row per delivery. Columns
    ``keep`` stay."""
    category, carrier = F.col("error_category"), F.col("carrier_code")
    message = (
        F.when(category == "VALIDATION", F.col("violation"))
        .when(category == "SHIPMENT_NOT_FOUND",
              F.format_string(M.TEXT_NOT_FOUND, F.col("shipment_id").cast("string")))
        .when(category == "CARRIER_MISMATCH",
              F.format_string(M.TEXT_MISMATCH, F.col("shipment_id").cast("string"),
                              F.col("registered_carrier"), carrier))
        .when(category == "UNSUPPORTED_CARRIER", F.format_string(M.TEXT_UNSUPPORTED, carrier))
        .when(category == "UNKNOWN_EVENT_TYPE",
              F.format_string(M.TEXT_UNKNOWN_CODE, carrier, F.col("event_type")))
        .otherwise(F.lit("Payload could not be decoded"))
    )
    error_type = F.lit(None).cast("string")
    for name, type_name in M.ERROR_TYPES:
        error_type = F.when(category == name, F.lit(type_name)).otherwise(error_type)
    payload = (F.coalesce(F.col("payload"), F.lit("")) if "payload" in outcomes.columns
               else wire_json(outcomes))
    return (
        outcomes.where(category.isNotNull())
        .select("event_id", "shipment_id", payload.alias("payload"), "error_category",
                error_type.alias("error_type"), message.alias("error_message"),
                F.col("topic").alias("original_topic"), F.col("partition").alias("original_partition"),
                F.col("offset").alias("original_offset"), F.col("received_at").alias("failed_at"),
                "arrival", *keep)
    )
