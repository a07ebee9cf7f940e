"""Current state per shipment, and the write-side commands on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import blank, code_units, digest


def current_state(folded: DataFrame, shipments: DataFrame) -> DataFrame:
    """``shipments`` after the batch: the last applied event decides, each one counts a version.

    The reduction is a plain aggregate (combined before the shuffle), so a heavy shipment is no
    concern here. Shipments without an applied event stay as they are.
    """
    return shipments_upsert(shipments, state_deltas(folded))


def state_deltas(folded: DataFrame) -> DataFrame:
    """One row per shipment the batch advanced."""
    last = F.max_by(F.struct("normalized_event_type", "event_time", "sequence_number", "received_at"), "arrival")
    return (folded.where("applied").groupBy("shipment_id")
            .agg(last.alias("_last"), F.count("*").alias("applied_events"))
            .select("shipment_id", F.col("_last.normalized_event_type").alias("current_status"),
                    F.col("_last.event_time").alias("last_event_time"),
                    F.col("_last.sequence_number").alias("last_sequence_number"),
                    F.col("_last.received_at").alias("last_received_at"), "applied_events"))


def shipments_upsert(snapshot: DataFrame, deltas: DataFrame) -> DataFrame:
    """Applies ``state_deltas`` rows to a snapshot; only touched rows change."""
    new = deltas.select("shipment_id", F.struct(
        "current_status", "last_event_time", "last_sequence_number", "last_received_at",
        "applied_events").alias("_new"))
    touched = F.col("_new").isNotNull()

    def pick(name, source=None):
        return F.when(touched, F.col("_new")[source or name]).otherwise(F.col(name)).alias(name)

    return snapshot.join(new, "shipment_id", "left").select(
        "shipment_id", "retailer_id", "customer_id", "tracking_number", "carrier_code",
        pick("current_status"), "estimated_delivery_date", pick("last_event_time"),
        pick("last_sequence_number"), pick("last_received_at"),
        (F.col("version") + F.coalesce(F.col("_new.applied_events"), F.lit(0))).alias("version"),
        "created_at", pick("updated_at", "last_received_at"))


def _checked(requests: DataFrame) -> DataFrame:
    """Registration requests with ``problem``: NULL, or the sorted list of broken constraints."""
    checks = []
    for name, wire, limit in (("retailer_id", "retailerId", 64), ("customer_id", "customerId", 64),
                              ("tracking_number", "trackingNumber", 128)):
        checks.append((f"{wire} {M.TEXT_NOT_BLANK}", blank(F.col(name))))
        checks.append((f"{wire} {M.TEXT_SIZE % limit}",
                       (F.length(name) > limit // 2) & (code_units(F.col(name)) > limit)))
    checks.append((f"carrierCode {M.TEXT_NOT_NULL}",
                   F.col("carrier_code").isNull() | ~F.col("carrier_code").isin(*M.CARRIERS)))
    found = F.array_join(F.sort_array(F.array(*[F.when(bad, F.lit(text)) for text, bad in checks])), ", ")
    return requests.withColumn("problem", F.when(found != "", found))


def register_shipments(requests: DataFrame, shipments: DataFrame) -> DataFrame:
    """New shipments from registration requests; the first valid request for a (carrier, tracking
    number) wins, unless that pair is registered already.

    First-wins is ``min_by``, combined before the shuffle, so repeats of one number cost nothing.
    """
    natural = ["carrier_code", "tracking_number"]
    first = (_checked(requests).where(F.col("problem").isNull())
             .groupBy(*natural)
             .agg(F.min_by(F.struct("request_id", "retailer_id", "customer_id", "estimated_delivery_date",
                                    "requested_at"), F.struct("requested_at", "request_id")).alias("_r"))
             .join(shipments.select(*natural), natural, "left_anti"))
    never = F.lit(None)
    return first.select(
        digest(F.col("carrier_code"), F.col("tracking_number")).alias("shipment_id"),
        F.col("_r.request_id").alias("request_id"), F.col("_r.retailer_id").alias("retailer_id"),
        F.col("_r.customer_id").alias("customer_id"), "tracking_number", "carrier_code",
        F.lit(M.INITIAL_STATUS).alias("current_status"),
        F.col("_r.estimated_delivery_date").alias("estimated_delivery_date"),
        never.cast("timestamp").alias("last_event_time"), never.cast("long").alias("last_sequence_number"),
        never.cast("timestamp").alias("last_received_at"), F.lit(0).cast("long").alias("version"),
        F.col("_r.requested_at").alias("created_at"), F.col("_r.requested_at").alias("updated_at"))


def register_rejected(requests: DataFrame, shipments: DataFrame) -> DataFrame:
    """Requests that registered nothing, with the reason."""
    checked = _checked(requests)
    # anti join on the unique request id: no pile-up on a tracking number that repeats a lot
    refused = checked.join(register_shipments(requests, shipments).select("request_id"),
                           "request_id", "left_anti")
    return refused.select(
        "request_id", "carrier_code", "tracking_number",
        F.when(F.col("problem").isNotNull(), "INVALID").otherwise("DUPLICATE").alias("reason"),
        F.coalesce("problem", F.format_string(
            M.TEXT_DUPLICATE_SHIPMENT, F.col("carrier_code"), F.col("tracking_number"))).alias("detail"))


def revise_estimates(revisions: DataFrame, shipments: DataFrame) -> DataFrame:
    """Shipments with their latest revised delivery estimate; a revision moves ``updated_at``."""
    latest = revisions.groupBy("shipment_id").agg(F.max_by(
        F.struct("estimated_delivery_date", "revised_at"),
        F.struct("revised_at", "revision_id")).alias("_rev"))
    return (shipments.join(latest, "shipment_id", "left")
            .withColumn("estimated_delivery_date", F.when(
                F.col("_rev").isNotNull(), F.col("_rev.estimated_delivery_date"))
                .otherwise(F.col("estimated_delivery_date")))
            .withColumn("updated_at", F.coalesce("_rev.revised_at", "updated_at"))
            .drop("_rev"))


def backfill_last_received(shipments: DataFrame, history: DataFrame) -> DataFrame:
    """Fills ``last_received_at`` from the applied history, where an event was applied at all."""
    latest = (history.where(F.col("processing_status") == "APPLIED")
              .groupBy("shipment_id").agg(F.max("received_at").alias("_latest")))
    return (shipments.join(latest, "shipment_id", "left")
            .withColumn("last_received_at", F.when(F.col("last_event_time").isNotNull(), F.col("_latest"))
                        .otherwise(F.col("last_received_at")))
            .drop("_latest"))
