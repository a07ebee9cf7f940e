"""Does what was sent match what was received, stored and refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _verdict(expected: Column, actual: Column) -> Column:
    return (F.when(expected.isNull() | actual.isNull(), "N/A")
            .when(expected == actual, "MATCH").otherwise("MISMATCH"))


def reconciliation(published: DataFrame, outcomes: DataFrame, history: DataFrame, failed: DataFrame,
                   dead_letters: DataFrame | None = None) -> DataFrame:
    """One line per check with both sides and a verdict.

    ``published`` is one row: ``events``, ``duplicates``, ``out_of_order`` as the sender counted
    them, NULL where it did not. Failures of one event are one failed event but a dead letter each: with
    ``dead_letters`` refused deliveries are compared with these, and failed events with the distinct
    events among them; without, deliveries are compared with failed events.
    """
    seen = outcomes.agg(
        F.count_if(F.col("outcome") != "MALFORMED_PAYLOAD").alias("received"),
        F.count_if(F.col("outcome") == "DUPLICATE").alias("duplicate"),
        F.count_if(F.col("outcome") == "SUPERSEDED").alias("late"),
        F.count_if(F.col("error_category").isNotNull()).alias("dead_lettered"))
    if dead_letters is not None:
        refused = outcomes.where(F.col("error_category").isNotNull())
        # ids are counted apart from rows without one, which are a failed event each
        events = refused.agg((F.count_distinct("event_id") + F.count_if(F.col("event_id").isNull())).alias("failed_ids"))
        extra = [events, dead_letters.agg(F.count("*").alias("letters"))]
    else:
        extra = []
    sides = [published.select("events", "duplicates", "out_of_order"), seen,
             history.agg(F.count("*").alias("stored")), failed.agg(F.count("*").alias("failed_rows")), *extra]
    # one-row aggregates side by side: stacked as (metric, value), then folded back into one row
    facts, names = None, []
    for side in sides:
        rows = side.select(*[F.col(c).cast("long").alias(c) for c in side.columns]).unpivot(
            [], side.columns, "metric", "value")
        facts = rows if facts is None else facts.unionByName(rows)
        names += side.columns
    one = facts.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
    lines = (
        ("published_received", F.col("events"), F.col("received")),
        ("duplicates_detected", F.col("duplicates"), F.col("duplicate")),
        ("out_of_order_detected", F.col("out_of_order"), F.col("late")),
        ("stored", F.col("events") - F.col("duplicates"), F.col("stored")),
        *([("failed_dead_lettered", F.col("dead_lettered"), F.col("failed_rows"))] if dead_letters is None else [
            ("failed_dead_lettered", F.col("dead_lettered"), F.col("letters")),
            ("failed_events", F.col("failed_ids"), F.col("failed_rows"))]),
    )
    rows = F.array(*[F.struct(F.lit(name).alias("line"), a.cast("long").alias("expected"),
                              b.cast("long").alias("actual")) for name, a, b in lines])
    return (one.select(F.explode(rows).alias("_l")).select("_l.*")
            .withColumn("verdict", _verdict(F.col("expected"), F.col("actual"))))


def reconcile_except(published: DataFrame, history: DataFrame) -> DataFrame:
    """Event ids on one side only: published minus repeats should equal stored.

    The same as the two ``exceptAll`` differences, from one combined aggregate over both sides.
    """
    both = (published.select("event_id", F.lit(1).alias("_sent"), F.lit(0).alias("_kept"))
            .unionByName(history.select("event_id", F.lit(0).alias("_sent"), F.lit(1).alias("_kept"))))
    surplus = both.groupBy("event_id").agg((F.sum("_kept") - F.max("_sent")).alias("_surplus"))
    return (surplus.where(F.col("_surplus") != 0)
            .select("event_id", F.when(F.col("_surplus") < 0, "not_stored").otherwise("not_published").alias("side"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_surplus"))).alias("_n")).drop("_n"))


def counter_deltas(before: DataFrame, after: DataFrame, seconds: Column) -> DataFrame:
    """Growth of each counter between two readings, and per second of the time between."""
    joined = after.select("metric", F.col("value").alias("after")).join(
        before.select("metric", F.col("value").alias("before")), "metric", "left")
    delta = F.col("after") - F.col("before")
    return joined.select("metric", "before", "after", delta.alias("delta"),
                         F.try_divide(delta, seconds).alias("per_second"))
