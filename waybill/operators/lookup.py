"""Enrichment joins: registered shipment and carrier vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import normalized_code


def resolve_shipments(events: DataFrame, shipments: DataFrame) -> DataFrame:
    """Left join to the registered shipment, bringing its carrier and the state it holds so far.

    No hint: Catalyst and AQE choose between broadcast and sort-merge by size, and AQE splits a
    heavy shipment on the event side (the other side has one row per key).
    """
    registered = shipments.select(
        "shipment_id",
        F.col("carrier_code").alias("registered_carrier"),
        F.col("current_status").alias("held_status"),
        F.col("last_event_time").alias("held_event_time"),
        F.col("last_sequence_number").alias("held_sequence_number"),
        F.col("last_received_at").alias("held_received_at"),
    )
    return events.join(registered, "shipment_id", "left").withColumns({
        "shipment_found": F.col("registered_carrier").isNotNull(),
        "carrier_matches": F.coalesce(F.col("registered_carrier") == F.col("carrier_code"), F.lit(False))})


def normalize_events(events: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """Adds ``carrier_supported`` and ``normalized_event_type`` (NULL for a code nobody declared).

    Without ``vocab`` the built-in vocabulary is looked up as a literal, which takes no join. A
    ``vocab`` of (carrier_code, code, status) rows is folded to one row per carrier, so a single
    join answers both questions; declaring a code twice is an error the folding raises.
    """
    code = normalized_code(F.col("event_type"))
    if vocab is None:
        statuses = F.create_map(*[F.lit(v) for carrier, c, status in M.VOCABULARY
                                  for v in (f"{carrier}/{c}", status)])
        return events.withColumns({
            "carrier_supported": F.coalesce(
                F.col("carrier_code").isin(*sorted({carrier for carrier, _, _ in M.VOCABULARY})), F.lit(False)),
            "normalized_event_type": F.try_element_at(statuses, F.concat("carrier_code", F.lit("/"), code))})
    per_carrier = vocab.groupBy("carrier_code").agg(
        F.map_from_entries(F.collect_list(F.struct("code", "status"))).alias("_codes"))
    return events.join(per_carrier, "carrier_code", "left").select(
        *events.columns, F.col("_codes").isNotNull().alias("carrier_supported"),
        F.try_element_at("_codes", code).alias("normalized_event_type"))


def vocabulary_conflicts(vocab: DataFrame) -> DataFrame:
    """(carrier, code) pairs that are declared more than once."""
    return (vocab.groupBy("carrier_code", "code").agg(F.count("*").alias("declarations"))
            .where(F.col("declarations") > 1))
