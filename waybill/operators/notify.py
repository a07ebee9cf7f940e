"""Milestone notifications from applied events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import digest

_PAIR = ["shipment_id", "source_event_id"]


def _candidates(folded: DataFrame) -> DataFrame:
    return folded.where("applied").select(
        "shipment_id", F.col("event_id").alias("source_event_id"),
        F.col("normalized_event_type").alias("status"), "received_at")


def notifications_new(folded: DataFrame, rules: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One pending notification per applied event of a notifiable status that has none yet."""
    due = _candidates(folded).join(rules, "status")
    if existing is not None:
        due = due.join(existing.select(*_PAIR), _PAIR, "left_anti")
    return due.select(
        digest(F.col("shipment_id"), F.col("source_event_id")).alias("notification_id"), *_PAIR,
        "notification_type", F.lit(M.NOTIFICATION_CHANNEL).alias("channel"),
        F.lit(M.NOTIFICATION_STATUS).alias("status"), F.col("received_at").alias("created_at"))


def notification_cause(notifications: DataFrame, history: DataFrame) -> DataFrame:
    """Each notification with the event that caused it."""
    cause = history.select(
        F.col("event_id").alias("source_event_id"), "carrier_event_type", "normalized_event_type",
        "event_time", "sequence_number", "processing_status")
    return (notifications.select("notification_id", *_PAIR, "notification_type", "created_at")
            .join(cause, "source_event_id"))


def notification_counts(notifications: DataFrame, rules: DataFrame) -> DataFrame:
    """Notifications per type, types without any at zero."""
    counted = notifications.groupBy("notification_type").agg(F.count("*").alias("_n"))
    return (rules.select("notification_type").join(counted, "notification_type", "left")
            .select("notification_type", F.coalesce("_n", F.lit(0)).cast("long").alias("notifications")))


def notification_skips(folded: DataFrame, rules: DataFrame, reasons: DataFrame,
                       existing: DataFrame | None = None) -> DataFrame:
    """Applied events that led to no notification, per reason, reasons without any at zero."""
    counted = skipped_events(folded, rules, existing).groupBy("reason").agg(F.count("*").alias("_n"))
    return (reasons.join(counted, "reason", "left")
            .select("reason", F.coalesce("_n", F.lit(0)).cast("long").alias("skipped")))


def skipped_events(folded: DataFrame, rules: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The applied events that led to no new notification, with the reason."""
    applied = _candidates(folded).join(rules, "status", "left")
    reason = F.when(F.col("notification_type").isNull(), "not_notifiable")
    if existing is not None:
        applied = applied.join(existing.select(*_PAIR, F.lit(True).alias("_exists")), _PAIR, "left")
        reason = reason.when(F.col("_exists"), "already_exists")
    return applied.select(*_PAIR, "received_at", reason.alias("reason")).where(F.col("reason").isNotNull())
