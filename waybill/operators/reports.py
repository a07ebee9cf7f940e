"""Counters, gauges, histograms and consistency reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model as M

def counters() -> dict[str, Column]:
    """The counters over classified deliveries.

    processed = applied + out_of_order + duplicate; what cannot be decoded never reaches
    processing, so it counts as failed and dead-lettered but not as received.
    """
    outcome, failed = F.col("outcome"), F.col("error_category").isNotNull()
    return {
        "received": F.count_if(outcome != "MALFORMED_PAYLOAD"),
        "processed": F.count_if(~failed),
        "applied": F.count_if(outcome == "APPLIED"),
        "out_of_order": F.count_if(outcome == "SUPERSEDED"),
        "duplicate": F.count_if(outcome == "DUPLICATE"),
        "failed": F.count_if(failed),
        "dead_lettered": F.count_if(failed),
    }


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(*[c.alias(name) for name, c in counters().items()])


def attempt_counts(outcomes: DataFrame) -> DataFrame:
    """The counters by try, from the tries each outcome was stored with (``attempts``). Each try is received;
    all fail but the last one of an event that is processed."""
    failed = F.col("error_category").isNotNull()

    def total(condition, amount):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("long")

    return outcomes.agg(
        total(F.col("outcome") != "MALFORMED_PAYLOAD", F.col("attempts")).alias("received"),
        F.count_if(~failed).alias("processed"),
        total(F.lit(True), F.col("attempts") - F.when(failed, 0).otherwise(1)).alias("failed"),
        F.count_if(failed).alias("dead_lettered"))


def counter_rows(outcomes: DataFrame) -> DataFrame:
    """``outcome_counts`` as (metric, value) rows."""
    names = list(counters())
    return outcome_counts(outcomes).unpivot([], names, "metric", "value")


def failures_by_category(outcomes: DataFrame, categories: DataFrame) -> DataFrame:
    """Failures per category, all categories present."""
    counted = (outcomes.where(F.col("error_category").isNotNull())
               .groupBy("error_category").agg(F.count("*").alias("_n")))
    return (categories.join(counted, "error_category", "left")
            .select("error_category", F.col("retryable_automatically").alias("retryable"),
                    F.coalesce("_n", F.lit(0)).cast("long").alias("failures")))


def backlog_gauges(shipments: DataFrame, failed: DataFrame) -> DataFrame:
    """Active shipments, failed events awaiting review, unresolved dead letters."""
    active = shipments.agg(F.count_if(F.col("current_status") != M.TERMINAL_STATUS).alias("value")).select(
        F.lit("shipments_active").alias("gauge"), "value")
    review = failed.agg(F.count_if(F.col("status") == "FAILED").alias("failed_events_awaiting_review"),
                        F.count_if(F.col("status") != "RESOLVED").alias("dead_letters_unresolved"))
    return active.unionByName(review.unpivot([], review.columns, "gauge", "value"))


def status_distribution(shipments: DataFrame) -> DataFrame:
    return (shipments.groupBy("current_status").agg(F.count("*").alias("shipments"))
            .orderBy(F.col("shipments").desc(), "current_status"))


def _per_shipment(history: DataFrame) -> DataFrame:
    return history.groupBy("shipment_id").agg(
        F.count("*").alias("stored_events"),
        F.count_if(F.col("processing_status") == "APPLIED").alias("applied_events"))


def version_invariant(shipments: DataFrame, history: DataFrame) -> DataFrame:
    """The version of a shipment counts its applied events."""
    zero = F.lit(0).cast("long")
    return (shipments.select("shipment_id", "version").join(_per_shipment(history), "shipment_id", "left")
            .select("shipment_id", "version", F.coalesce("stored_events", zero).alias("stored_events"),
                    F.coalesce("applied_events", zero).alias("applied_events"))
            .withColumn("holds", F.col("version") == F.col("applied_events")))


def shipment_consistency(shipments: DataFrame, history: DataFrame) -> DataFrame:
    """Each shipment's state next to the number of its history rows."""
    events = history.groupBy("shipment_id").agg(F.count("*").alias("_n"))
    return (shipments.select("shipment_id", "current_status", "last_sequence_number")
            .join(events, "shipment_id", "left")
            .select("shipment_id", "current_status", "last_sequence_number",
                    F.coalesce("_n", F.lit(0)).cast("long").alias("events")))


def lag_seconds() -> Column:
    """Time from a scan to its reception."""
    return (F.unix_micros("received_at") - F.unix_micros("event_time")) / F.lit(1e6)


def bucket_index(value: Column, edges: list[float]) -> Column:
    """Index of the first edge not below ``value``; ``len(edges)`` above them all."""
    index = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        index = F.when(value <= edges[i], i).otherwise(index)
    return index


def bucket_counts(edges: list[float]) -> list[Column]:
    """Cumulative counts up to each edge, and overall, from a ``_bucket`` column."""
    return [F.count_if(F.col("_bucket") <= i).alias(f"_le{i}") for i in range(len(edges) + 1)]


def histogram_rows(counted: DataFrame, by: list[str], edges: list[float]) -> DataFrame:
    """``bucket_counts`` columns as ``by, le, cumulative`` rows; ``le`` is NULL for +infinity."""
    bounds = F.array(*[F.lit(float(e)) for e in edges], F.lit(None).cast("double"))
    values = F.array(*[F.col(f"_le{i}") for i in range(len(edges) + 1)])
    return (counted.select(*by, F.explode(F.arrays_zip(bounds.alias("le"), values.alias("cumulative"))).alias("_b"))
            .select(*by, F.col("_b.le").alias("le"), F.col("_b.cumulative").alias("cumulative")))


def lag_histogram(history: DataFrame, edges: list[float]) -> DataFrame:
    """Cumulative buckets of the ingest lag by processing outcome."""
    counted = (history.select("processing_status", bucket_index(lag_seconds(), edges).alias("_bucket"))
               .groupBy("processing_status").agg(*bucket_counts(edges)))
    return histogram_rows(counted, ["processing_status"], edges)


def lag_quantiles(histogram: DataFrame, qs: list[float], by: list[str] | None = None) -> DataFrame:
    """Quantiles from cumulative buckets: linear within the bucket that holds the rank.

    Above the last finite edge the answer is that edge; the first bucket starts at zero.
    """
    by = ["processing_status"] if by is None else by
    group = Window.partitionBy(*by)
    ordered = group.orderBy(F.col("le").asc_nulls_last())
    steps = (histogram
             .withColumn("_from", F.coalesce(F.lag("le").over(ordered), F.lit(0.0)))
             .withColumn("_below", F.coalesce(F.lag("cumulative").over(ordered), F.lit(0)))
             .withColumn("_total", F.max("cumulative").over(group)))
    ranked = (steps.withColumn("quantile", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
              .withColumn("_rank", F.col("quantile") * F.col("_total"))
              # the bucket whose count first reaches the rank
              .where((F.col("_total") > 0) & (F.col("cumulative") >= F.col("_rank"))
                     & ((F.col("_below") < F.col("_rank"))
                        | ((F.col("_below") == 0) & (F.col("_rank") == 0) & (F.col("_from") == 0)))))
    return ranked.select(
        *by, "quantile",
        F.when(F.col("le").isNull(), F.col("_from")).otherwise(
            F.col("_from") + (F.col("le") - F.col("_from"))
            * ((F.col("_rank") - F.col("_below")) / (F.col("cumulative") - F.col("_below"))))
        .alias("seconds"))


def quantile_of(cumulative: list[Column], edges: list[float], q: Column) -> Column:
    """The same from the cumulative counts of one row (up to each edge, then all); NULL without any."""
    total, below, lower = cumulative[-1], F.lit(0), F.lit(0.0)
    rank, value = q * total, F.lit(None).cast("double")
    steps = []
    for i, count in enumerate(cumulative):
        inside = lower if i == len(edges) else (
            lower + (F.lit(float(edges[i])) - lower) * ((rank - below) / F.nullif(count - below, F.lit(0))))
        steps.append((count >= rank, inside))
        if i < len(edges):
            below, lower = count, F.lit(float(edges[i]))
    for reached, inside in reversed(steps):
        value = F.when(reached, inside).otherwise(value)
    return F.when(total > 0, value)


def duration_histogram(outcomes: DataFrame, edges: list[float]) -> DataFrame:
    """Cumulative buckets of the time from scan to reception, for each of the four results of processing;
    a result that has not occurred is there with zeros. Deliveries without an event time have no duration."""
    failed = F.col("error_category").isNotNull()
    result = F.when(failed, "FAILED").when(F.col("outcome") == "SUPERSEDED", "OUT_OF_ORDER").otherwise(F.col("outcome"))
    counted = (outcomes.where(F.col("event_time").isNotNull())
               .select(result.alias("outcome"), bucket_index(lag_seconds(), edges).alias("_bucket"))
               .groupBy("outcome").agg(*bucket_counts(edges)))
    names = [f"_le{i}" for i in range(len(edges) + 1)]
    every = M.processing_results(outcomes.sparkSession).join(counted, "outcome", "left").na.fill(0, names)
    return histogram_rows(every, ["outcome"], edges)


def partition_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Records not yet consumed per partition, and the largest of them."""
    lag = (ends.join(committed, ["topic", "partition"], "left")
           .select("topic", "partition", "end_offset",
                   (F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))).alias("lag")))
    return lag.withColumn("max_lag", F.max("lag").over(Window.partitionBy("topic")))
