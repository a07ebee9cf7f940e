"""The failed-event table: collapse and upsert, dead letters, retries and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import bounded, digest


def bound_error_text(failures: DataFrame) -> DataFrame:
    """Error texts cut to what the table holds."""
    return (failures.withColumn("error_message", bounded(F.col("error_message"), M.MAX_ERROR_MESSAGE))
            .withColumn("error_type", bounded(F.col("error_type"), M.MAX_ERROR_TYPE)))


def failed_events_upsert(snapshot: DataFrame | None, failures: DataFrame) -> DataFrame:
    """The failed-event table after a batch of failures.

    Failures of one event are one row: where, what and since when come from the first, the cause
    and the latest time from the last; a new failure reopens the row and leaves its retry count.
    A failure without event id is always a row of its own. Those rows bypass grouping and join,
    where their NULL key would collect them in one task.
    """
    bounded_failures = bound_error_text(failures)
    origin = ["original_topic", "original_partition", "original_offset"]
    anonymous = bounded_failures.where(F.col("event_id").isNull()).select(
        digest(*[F.col(c) for c in origin]).alias("failed_event_id"), "event_id", "shipment_id", "payload",
        "error_category", "error_type", "error_message", F.lit(0).alias("retry_count"),
        F.lit("FAILED").alias("status"), *origin, F.col("failed_at").alias("first_failed_at"),
        F.col("failed_at").alias("last_failed_at"), F.lit(0).cast("long").alias("version"))

    collapsed = (
        bounded_failures.where(F.col("event_id").isNotNull()).groupBy("event_id")
        .agg(F.min_by(F.struct("shipment_id", "payload", *origin, "failed_at"), "arrival").alias("_first"),
             F.max_by(F.struct("error_category", "error_type", "error_message", "failed_at"),
                      "arrival").alias("_last"),
             F.count("*").alias("_n")))
    if snapshot is None:
        named = collapsed.select(
            digest(F.col("event_id")).alias("failed_event_id"), "event_id", "_first.shipment_id",
            "_first.payload", "_last.error_category", "_last.error_type", "_last.error_message",
            F.lit(0).alias("retry_count"), F.lit("FAILED").alias("status"),
            *[f"_first.{c}" for c in origin], F.col("_first.failed_at").alias("first_failed_at"),
            F.col("_last.failed_at").alias("last_failed_at"), (F.col("_n") - 1).alias("version"))
        return named.unionByName(anonymous)

    new, old = F.col("_n").isNotNull(), F.col("failed_event_id").isNotNull()

    def kept(name, source=None):
        return F.when(old, F.col(name)).otherwise(F.col("_first")[source or name]).alias(name)

    def latest(name, source=None):
        return F.when(new, F.col("_last")[source or name]).otherwise(F.col(name)).alias(name)

    named = snapshot.where(F.col("event_id").isNotNull()).join(collapsed, "event_id", "full").select(
        F.coalesce("failed_event_id", digest(F.col("event_id"))).alias("failed_event_id"), "event_id",
        kept("shipment_id"), kept("payload"), latest("error_category"), latest("error_type"),
        latest("error_message"), F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
        F.when(new, "FAILED").otherwise(F.col("status")).alias("status"), *[kept(c) for c in origin],
        kept("first_failed_at", "failed_at"), latest("last_failed_at", "failed_at"),
        (F.coalesce("version", F.lit(-1)) + F.coalesce("_n", F.lit(0))).cast("long").alias("version"))
    untouched = snapshot.where(F.col("event_id").isNull())
    return named.unionByName(untouched).unionByName(anonymous)


def dead_letters(failures: DataFrame) -> DataFrame:
    """Dead-letter records: the original bytes with their origin and cause."""
    return failures.select(
        F.col("shipment_id").cast("string").alias("key"), F.col("payload").alias("value"),
        "original_topic", "original_partition", "original_offset",
        F.col("error_category"), F.col("error_type").alias("exception_type"),
        F.col("error_message").alias("exception_message"), F.col("failed_at").alias("dead_lettered_at"))


def retry_schedule(failures: DataFrame, categories: DataFrame, initial_ms: int = M.RETRY_INITIAL_MS,
                   multiplier: float = M.RETRY_MULTIPLIER, max_ms: int = M.RETRY_MAX_MS,
                   retries: int = M.RETRY_LIMIT) -> DataFrame:
    """The automatic attempts each retryable failure is due, with capped exponential backoff."""
    retryable = failures.join(categories.where("retryable_automatically"), "error_category", "left_semi")
    waits = [min(int(initial_ms * multiplier ** n), max_ms) for n in range(retries)]
    attempts = F.array(*[F.struct(F.lit(n + 1).alias("attempt"), F.lit(wait).alias("wait_ms"),
                                  F.lit(sum(waits[:n + 1])).alias("elapsed_ms"))
                         for n, wait in enumerate(waits)])
    return (retryable.select("event_id", "arrival", "failed_at", F.explode(attempts).alias("_a"))
            .select("event_id", "arrival", "_a.attempt", "_a.wait_ms",
                    F.timestamp_micros(F.unix_micros("failed_at") + F.col("_a.elapsed_ms") * 1000)
                    .alias("due_at")))


def replay_eligible(failed: DataFrame, categories: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Failed events an operator may replay: open ones of a category a replay can help."""
    chosen = failed if ids is None else failed.join(ids.select("failed_event_id"), "failed_event_id", "left_semi")
    return (chosen.where(F.col("status") == "FAILED")
            .join(categories.where("retryable_manually"), "error_category", "left_semi"))


def replay_result(failed: DataFrame, attempts: DataFrame) -> DataFrame:
    """The failed-event table after a replay.

    ``attempts`` has one row per replayed ``failed_event_id`` with ``error_category`` NULL for
    success (being a duplicate is one), else category, type, message of the new failure, and
    ``failed_at``. The outcome is one update of the row, so the version moves by one.
    """
    tried = bound_error_text(attempts).select("failed_event_id", F.struct(
        "error_category", "error_type", "error_message", "failed_at").alias("_try"))
    hit = F.col("_try").isNotNull()
    again = hit & F.col("_try.error_category").isNotNull()
    out = failed.join(tried, "failed_event_id", "left")
    return out.select(*[
        {
            "status": F.when(again, "FAILED").when(hit, "RESOLVED").otherwise(F.col("status")),
            "retry_count": (F.col("retry_count") + again.cast("int")),
            "error_category": F.when(again, F.col("_try.error_category")).otherwise(F.col("error_category")),
            "error_type": F.when(again, F.col("_try.error_type")).otherwise(F.col("error_type")),
            "error_message": F.when(again, F.col("_try.error_message")).otherwise(F.col("error_message")),
            "last_failed_at": F.when(again, F.col("_try.failed_at")).otherwise(F.col("last_failed_at")),
            "version": F.col("version") + hit.cast("long"),
        }.get(c, F.col(c)).alias(c) for c in failed.columns])
