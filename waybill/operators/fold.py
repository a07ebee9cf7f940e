"""The ordering rule: which stored events advance their shipment.

In arrival order per shipment, an event is accepted unless the shipment is already delivered or
holds a greater key, where key = (sequence number, event time, received at) and ties accept.

No sequential state is needed. Before delivery the accepted keys are exactly the running maxima,
and a rejected key never exceeds the running maximum, so the key held by the shipment equals the
maximum over all earlier stored rows. That is a window. Delivery is a second window over the first.

A shipment with a heavy share of the rows is cut into consecutive pieces of its arrival order, of equal
numbers of rows. Each piece is scanned on its own; what earlier pieces pass on (greatest key, delivered
or not) is one small row per piece, combined by a window over pieces and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model as M
from .skew import DETECT, HeavyKeys, cut_lineage, in_pieces, resolve_heavy

HELD = ("held_status", "held_event_time", "held_sequence_number", "held_received_at")


def ordering_fold(stored: DataFrame, seed: DataFrame | None = None, *,
                  heavy: HeavyKeys | None = DETECT) -> DataFrame:
    """Adds ``applied``: true where the event advanced its shipment.

    Rows may carry a ``stored`` flag; rows without it take no part (masked, not filtered, so one
    pass serves all outcomes). State held before this batch comes from ``seed`` (a shipments
    table) or from ``held_*`` columns an earlier join has brought along. ``heavy`` names the
    shipments to scan in pieces, if they are known already (None: there are none); only with such
    shipments the input is written out, for it is read twice.
    """
    heavy = resolve_heavy(heavy, stored, "shipment_id")
    df = stored
    if seed is not None:
        df = df.join(seed.select(
            "shipment_id", F.col("current_status").alias(HELD[0]), F.col("last_event_time").alias(HELD[1]),
            F.col("last_sequence_number").alias(HELD[2]), F.col("last_received_at").alias(HELD[3])),
            "shipment_id", "left")
    light, crowded = _divided(df, heavy)
    folded = _fold(light, df.columns)
    if crowded is None:
        return folded
    return folded.unionByName(_fold(crowded, df.columns, _carry))


def _fold(df: DataFrame, columns: list[str], carry=None) -> DataFrame:
    local = df.withColumn("_earlier", F.max(F.when(_takes_part(df), _key())).over(_before()))
    folded, carried, frozen = local, [F.col("_earlier"), _held_key(df)], F.lit(False)
    if carry is not None:
        folded = local.join(carry(local, df), ["shipment_id", "_chunk"], "left")
        carried.append(F.col("_carried"))
        frozen = F.coalesce(F.col("_frozen"), F.lit(False))
    best = F.greatest(*carried)
    folded = folded.withColumn("_wins", _takes_part(df) & (best.isNull() | (_key() >= best)))
    frozen = frozen | F.coalesce(F.max(F.col("_wins") & _delivers()).over(_before()), F.lit(False))
    if HELD[0] in df.columns:
        frozen = frozen | F.coalesce(F.col(HELD[0]) == M.TERMINAL_STATUS, F.lit(False))
    return folded.select(*columns, (F.col("_wins") & ~frozen).alias("applied"))


def applied_timeline(folded: DataFrame, *, heavy: HeavyKeys | None = DETECT) -> DataFrame:
    """Adds ``status_before`` and ``status_after``: the shipment's status around each event."""
    heavy = resolve_heavy(heavy, folded, "shipment_id")
    light, crowded = _divided(folded, heavy)
    lined = _timeline(light, folded.columns)
    if crowded is None:
        return lined
    return lined.unionByName(_timeline(crowded, folded.columns, _last_status))


def _timeline(df: DataFrame, columns: list[str], carry=None) -> DataFrame:
    local = df.withColumn("_earlier", F.last(_status(), ignorenulls=True).over(_before()))
    known = [F.col("_earlier")]
    if carry is not None:
        local = local.join(carry(local), ["shipment_id", "_chunk"], "left")
        known.append(F.col("_carried"))
    if HELD[0] in columns:
        known.append(F.col(HELD[0]))
    return (local.withColumn("status_before", F.coalesce(*known, F.lit(M.INITIAL_STATUS)))
            .withColumn("status_after", F.coalesce(_status(), F.col("status_before")))
            .select(*columns, "status_before", "status_after"))


def _last_status(local: DataFrame) -> DataFrame:
    """Per piece of a heavy shipment: the last status applied in the pieces before."""
    per_chunk = (local.groupBy("shipment_id", "_chunk")
                 .agg(F.max_by(_status(), F.when(F.col("applied"), F.col("arrival"))).alias("_last")))
    return per_chunk.select("shipment_id", "_chunk", F.last("_last", ignorenulls=True)
                            .over(_chunks_before()).alias("_carried"))


def _status() -> Column:
    return F.when(F.col("applied"), F.col("normalized_event_type"))


def _key() -> Column:
    return F.struct("sequence_number", "event_time", "received_at")


def _held_key(df: DataFrame) -> Column:
    if HELD[1] not in df.columns:
        return F.when(F.lit(False), _key())
    return F.when(F.col(HELD[1]).isNotNull(), F.struct(
        F.col(HELD[2]).alias("sequence_number"), F.col(HELD[1]).alias("event_time"),
        F.col(HELD[3]).alias("received_at")))


def _takes_part(df: DataFrame) -> Column:
    return F.col("stored") if "stored" in df.columns else F.lit(True)


def _delivers() -> Column:
    return F.coalesce(F.col("normalized_event_type") == M.TERMINAL_STATUS, F.lit(False))


def _before():
    return (Window.partitionBy("shipment_id", "_chunk").orderBy("arrival")
            .rowsBetween(Window.unboundedPreceding, -1))


def _chunks_before():
    return (Window.partitionBy("shipment_id").orderBy("_chunk")
            .rowsBetween(Window.unboundedPreceding, -1))


def _divided(df: DataFrame, heavy: HeavyKeys | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary shipments (``_chunk`` 0, a spread of negative values for rows that take no part),
    and those of heavy shipments in pieces."""
    aside = -1 - F.pmod(F.xxhash64("arrival"), F.lit(1 << 30))
    lane = F.when(_takes_part(df), F.lit(0)).otherwise(aside).cast("long")
    if heavy is None:
        return df.withColumn("_chunk", lane), None
    known = heavy.rows.select("shipment_id", F.lit(True).alias("_heavy"))
    tagged = cut_lineage(df.join(heavy.side(known), "shipment_id", "left")
                         .withColumn("_heavy", F.coalesce("_heavy", F.lit(False)) & _takes_part(df)))
    light = tagged.where(~F.col("_heavy")).withColumn("_chunk", lane)
    return light, in_pieces(tagged.where("_heavy"), "shipment_id", heavy)


def _carry(local: DataFrame, df: DataFrame) -> DataFrame:
    """Per piece of a heavy shipment: greatest earlier key, and whether it was delivered before.

    A piece delivers iff its last locally accepted delivery beats everything carried into it, so
    one aggregate per piece is enough to know in which piece the shipment freezes.
    """
    lands = _delivers() & (F.col("_earlier").isNull() | (_key() >= F.col("_earlier")))
    per_chunk = (
        local.groupBy("shipment_id", "_chunk")
        .agg(F.max(_key()).alias("_top"), F.max(F.when(lands, _key())).alias("_landing"),
             F.first(_held_key(df)).alias("_held"))
        .withColumn("_carried", F.greatest(F.max("_top").over(_chunks_before()), F.col("_held")))
        .withColumn("_freezes", F.col("_landing").isNotNull()
                    & (F.col("_carried").isNull() | (F.col("_landing") >= F.col("_carried"))))
    )
    return per_chunk.select("shipment_id", "_chunk", "_carried",
                            F.max("_freezes").over(_chunks_before()).alias("_frozen"))
