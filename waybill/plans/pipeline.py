"""The masked single pass from decoded events to one classified row per delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import mark_duplicates, tag_heavy_ids
from ..operators.fold import ordering_fold
from ..operators.lookup import normalize_events, resolve_shipments
from ..operators.outcome import add_storable, classify_outcome
from ..operators.skew import DEFAULT, SkewPolicy, find_heavy, find_shared
from ..operators.validate import validate_events


def assess(events: DataFrame, shipments: DataFrame, vocab: DataFrame | None = None, *,
           by_shipment: bool = False) -> DataFrame:
    """Everything that can be said about a delivery by itself: validation, lookups, flags.

    With ``by_shipment`` the rows are brought together by shipment, once their texts are reduced to flags."""
    if not by_shipment:
        return add_storable(normalize_events(resolve_shipments(validate_events(events), shipments), vocab))
    checked = normalize_events(validate_events(events), vocab)
    last = [c for c in checked.columns if c in ("carrier_supported", "normalized_event_type")]
    resolved = resolve_shipments(checked.repartition("shipment_id"), shipments)
    return add_storable(resolved.select(*[c for c in resolved.columns if c not in last], *last))


def outcome_stream(events: DataFrame, shipments: DataFrame, vocab: DataFrame | None = None,
                   history: DataFrame | None = None, *, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Every delivery with its outcome: APPLIED, SUPERSEDED, DUPLICATE, or an error category.

    Nothing is split off and unioned back: rows that are not stored are masked in the windows, so
    the whole pass costs one shuffle by event id and one by shipment id. ``shipments`` is the state
    before the batch (it seeds the fold), ``history`` the ids stored before it.

    A large feed without heavy keys costs one shuffle by shipment id, which serves the look-up, the
    redelivery check and the fold. Ids that several shipments share are found first and treated like
    heavy ids: their first storable arrival is aggregated apart. With too many of them, or with a
    history to compare with, the pass is as above.
    """
    # the raw events are enough to find heavy keys, and few columns of them are read
    heavy = find_heavy(events, ["event_id", "shipment_id"], policy)
    apart, by_shipment = heavy.get("event_id"), False
    if history is None and not heavy:
        by_shipment, apart = find_shared(events, policy)
    if apart is not None:
        events = tag_heavy_ids(events, apart)
    marked = mark_duplicates(assess(events, shipments, vocab, by_shipment=by_shipment), history, heavy=apart,
                             by_shipment=by_shipment)
    masked = marked.withColumn("stored", F.col("storable") & ~F.col("is_duplicate"))
    return classify_outcome(ordering_fold(masked, heavy=heavy.get("shipment_id")))


def history_of(outcomes: DataFrame) -> DataFrame:
    """The rows of the append-only history."""
    return outcomes.where(F.col("stored")).select(
        "event_id", "shipment_id", "tracking_number", "carrier_code",
        F.col("event_type").alias("carrier_event_type"), "normalized_event_type", "event_time",
        "received_at", "sequence_number", "location", "description", "correlation_id",
        F.col("outcome").alias("processing_status"))
