"""Redelivery detection. The key is the event id alone, across all shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import DETECT, HeavyKeys, resolve_heavy


def mark_duplicates(events: DataFrame, history: DataFrame | None = None, *,
                    heavy: HeavyKeys | None = DETECT, by_shipment: bool = False) -> DataFrame:
    """Adds ``is_duplicate``: a valid event whose id was stored before.

    Expects ``valid`` (decoded and validated) and ``storable`` (would be stored if it is no
    duplicate). Only a storable row stores its id, so an earlier *failed* delivery does not count.

    One shuffle by event id. Rows that cannot be duplicates (NULL ids, invalid bodies) would pile up
    there and are spread by arrival. So are the copies of a heavy id: its first storable arrival
    comes from a map-side combined aggregate instead. ``heavy`` names such ids, if they are known
    already (None: there are none).

    With ``by_shipment`` there is no shuffle if the rows are together by shipment already: ``heavy``
    then has to name all ids that occur in several shipments (``find_shared``).
    """
    heavy = resolve_heavy(heavy, events, "event_id")
    can_repeat = F.col("valid") & F.col("event_id").isNotNull()
    marked, together = events, can_repeat
    if heavy is not None:
        if "heavy_id" not in events.columns:
            marked = tag_heavy_ids(events, heavy)
        leader = F.struct("arrival", "shipment_id") if by_shipment else F.struct("arrival")
        firsts = (marked.where("heavy_id").groupBy("event_id")
                  .agg(F.min(F.when(F.col("storable"), leader)).alias("_leader"))
                  .select("event_id", F.col("_leader.arrival").alias("_heavy_first"),
                          *([F.col("_leader.shipment_id").alias("_heavy_home")] if by_shipment else [])))
        if history is not None:
            firsts = firsts.join(history.select("event_id", F.lit(True).alias("_heavy_known")),
                                 "event_id", "left")
        marked = marked.join(heavy.side(firsts), "event_id", "left")
        together = can_repeat & ~F.col("heavy_id")
    marked = marked.withColumn("_lane", F.when(together, F.lit(0).cast("long"))
                               .otherwise(F.xxhash64("arrival")))
    if history is not None:
        marked = marked.join(
            history.select("event_id", F.lit(0).cast("long").alias("_lane"), F.lit(True).alias("_known")),
            ["event_id", "_lane"], "left")

    lane = Window.partitionBy(*(["shipment_id"] if by_shipment else []), "event_id", "_lane")
    first = F.min(F.when(F.col("storable"), F.col("arrival"))).over(lane)
    # the same record read twice has one arrival, so one lane; only one of the two is the first
    again = F.row_number().over(lane.orderBy(~F.col("storable"), "arrival")) > 1
    again = F.col("storable") & again & F.coalesce(F.col("arrival") == F.col("_first"), F.lit(False))
    known = [c for c in ("_known", "_heavy_known") if c in marked.columns]
    if heavy is not None:
        first = F.when(F.col("heavy_id"), F.col("_heavy_first")).otherwise(first)
        if by_shipment:     # of copies with one arrival in several shipments, one is the first
            again = again | F.coalesce(F.col("heavy_id") & F.col("storable") & (F.col("arrival") == F.col("_heavy_first"))
                                       & (F.col("shipment_id") != F.col("_heavy_home")), F.lit(False))
    return marked.withColumn("_first", first).withColumn("_again", again).select(
        *[c for c in events.columns if c != "heavy_id"],
        (can_repeat & (F.coalesce(*known, F.lit(False))
                       | F.coalesce(F.col("arrival") > F.col("_first"), F.lit(False))
                       | F.col("_again"))).alias("is_duplicate"))


def tag_heavy_ids(events: DataFrame, heavy: HeavyKeys) -> DataFrame:
    """Adds ``heavy_id``. Done on the raw events, the tag lets Catalyst push the restriction to
    heavy ids below the lookups that follow."""
    ids = heavy.rows.select("event_id", F.lit(True).alias("heavy_id"))
    return (events.join(heavy.side(ids), "event_id", "left")
            .withColumn("heavy_id", F.coalesce("heavy_id", F.lit(False))))


def duplicates_semi(events: DataFrame, history: DataFrame) -> DataFrame:
    """Events whose id is already in history."""
    return events.join(history.select("event_id"), "event_id", "left_semi")


def new_events_anti(events: DataFrame, history: DataFrame) -> DataFrame:
    """Events whose id is not in history."""
    return events.join(history.select("event_id"), "event_id", "left_anti")


def duplicate_report(events: DataFrame, history: DataFrame, shipments: DataFrame) -> DataFrame:
    """What a redelivery is answered with: the outcome stored for the first delivery and the
    status the shipment of that delivery has *now*."""
    stored = history.select(
        "event_id", F.col("shipment_id").alias("stored_shipment_id"),
        F.col("normalized_event_type").alias("stored_event_type"),
        F.col("processing_status").alias("stored_processing_status"))
    now = shipments.select(F.col("shipment_id").alias("stored_shipment_id"), "current_status")
    return (events.select("event_id", "arrival")
            .join(stored, "event_id")
            .join(now, "stored_shipment_id", "left")
            .select("event_id", "arrival", F.col("stored_shipment_id").alias("shipment_id"),
                    "stored_event_type", "current_status", "stored_processing_status",
                    F.lit(True).alias("duplicate")))
