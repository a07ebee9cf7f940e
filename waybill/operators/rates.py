"""Rates over time windows and the alerts on them. Time is reception time.

Deliveries collapse to counts per step (a minute, say) first, combined before the shuffle; sliding
lookbacks are then built from those counts. A row is never multiplied by the number of windows it
falls into, only the per-step counts are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio_floor
from .reports import bucket_counts, bucket_index, counters, lag_seconds, quantile_of
from .skew import cut_lineage

_DAY = 86_400
SILENT_DAYS = 31        # days of a silence that have evaluation times
_METRICS = ("received", "processed", "applied", "out_of_order", "duplicate", "failed", "dead_lettered")


def _tumbling(width: int) -> Column:
    return F.window("received_at", f"{width} seconds").getField("start")


def _per_second(count: Column, width: int) -> Column:
    return count / F.lit(float(width))


def event_rates(outcomes: DataFrame, width: int = 300) -> DataFrame:
    """Events per second of every counter, per tumbling window of ``width`` seconds."""
    counted = outcomes.groupBy(_tumbling(width).alias("window_start")).agg(
        *[c.alias(name) for name, c in counters().items()])
    return counted.select("window_start", *[_per_second(F.col(m), width).alias(f"{m}_rate") for m in _METRICS])


def failure_rates(outcomes: DataFrame, width: int = 300) -> DataFrame:
    """Failures per second by category and window."""
    return (outcomes.where(F.col("error_category").isNotNull())
            .groupBy(_tumbling(width).alias("window_start"), "error_category")
            .agg(_per_second(F.count("*"), width).alias("rate")))


def rates_by_carrier(outcomes: DataFrame, width: int = 300) -> DataFrame:
    """Deliveries per second by carrier, outcome and window."""
    return (outcomes.groupBy(_tumbling(width).alias("window_start"), "carrier_code", "outcome")
            .agg(F.count("*").alias("deliveries"))
            .withColumn("rate", _per_second(F.col("deliveries"), width)))


def rates_sliding(outcomes: DataFrame, width: int = 600, slide: int = 60) -> DataFrame:
    """Received, failed and dead-lettered per second over a sliding lookback.

    ``window_end`` is the time of evaluation; ``width`` is a multiple of ``slide``.
    """
    counts = _step_counts(outcomes, slide, ("received", "failed", "dead_lettered"))
    summed = _lookback(counts, width, slide)
    return summed.select("window_end", *[
        _per_second(F.col(m), width).alias(f"{m}_rate") for m in ("received", "failed", "dead_lettered")])


def failure_ratio(outcomes: DataFrame, width: int = 300, floor: float = 0.001) -> DataFrame:
    """Failed over received rate per window; the floor keeps an idle window from dividing by zero."""
    rates = event_rates(outcomes, width)
    return rates.select("window_start", "failed_rate", "received_rate", ratio_floor(
        F.col("failed_rate"), F.col("received_rate"), floor).alias("failure_ratio"))


def time_spine(outcomes: DataFrame, step: int, extra: int = 0) -> DataFrame:
    """Every evaluation time from the first to the last reception, ``extra`` seconds longer.

    Of a silence, only the first ``SILENT_DAYS`` days have evaluation times: a stray reception far away
    from all others costs some days, not all the time between."""
    return _spine(outcomes.select(F.window("received_at", f"{step} seconds").getField("end").alias("_step")),
                  step, extra)


def _spine(steps: DataFrame, step: int, extra: int) -> DataFrame:
    """The days that matter come from the steps, combined before the shuffle; each makes its own times."""
    second = F.unix_seconds("_step")
    span = steps.agg(F.min(second).alias("low"), F.max(second).alias("high"))
    day = F.floor(second / _DAY)
    days = (steps.select(day.alias("_day")).distinct()
            .select(F.explode(F.sequence("_day", F.col("_day") + F.lit(SILENT_DAYS + math.ceil(extra / _DAY)))).alias("_day"))
            .distinct())
    first = F.ceil(F.col("_day") * F.lit(_DAY) / step) * step            # evaluation times are multiples of the step
    last = F.ceil((F.col("_day") + 1) * F.lit(_DAY) / step) * step - step
    times = days.where(first <= last).select(F.explode(F.sequence(first, last, F.lit(step).cast("long"))).alias("_at"))
    within = F.col("_at").between(span.select("low").scalar(), span.select(F.col("high") + extra).scalar())
    return times.where(within).select(F.timestamp_seconds("_at").alias("window_end"))


def silence(outcomes: DataFrame, spine: DataFrame, width: int = 900, hold: int = 1800, step: int = 60) -> DataFrame:
    """Evaluation times with nothing received over ``width``, firing once that held for ``hold``."""
    counts = _lookback(_step_counts(outcomes, step, ("received",)), width, step)
    values = spine.join(counts, "window_end", "left").select(
        "window_end", F.coalesce("received", F.lit(0)).cast("long").alias("received"))
    condition = values.withColumn("silent", F.col("received") == 0)
    held = sustained(condition.select(F.lit("NoEventsReceived").alias("rule"), "window_end",
                                      F.col("silent").alias("holds"), F.lit(hold).alias("hold_seconds")), step)
    return condition.join(held.select("window_end", "firing"), "window_end")


def sustained(conditions: DataFrame, step: int) -> DataFrame:
    """Adds ``firing``: the condition held at every evaluation of the last ``hold_seconds``.

    ``conditions`` is dense: a row per rule and evaluation time. Each true evaluation votes for
    the evaluation times it counts towards; a full house fires. Votes and the rows themselves meet in
    one combined aggregate, so no group has to be walked in order.
    """
    names = [c for c in conditions.columns if c not in ("rule", "window_end")]
    offsets = F.when(F.col("holds"), F.sequence(F.lit(0), F.col("hold_seconds").cast("int"), F.lit(step))).otherwise(
        F.array(F.lit(0)))
    votes = conditions.select("rule", "window_end", F.struct(*names).alias("_row"), F.explode(offsets).alias("_offset"))
    own = F.when(F.col("_offset") == 0, F.col("_row"))
    counted = (votes.select("rule", (F.col("window_end") + F.make_dt_interval(secs=F.col("_offset"))).alias("window_end"),
                            own.alias("_row"), F.col("_row.holds").alias("_vote"))
               .groupBy("rule", "window_end")
               .agg(F.first("_row", ignorenulls=True).alias("_row"), F.count_if("_vote").alias("_votes"))
               .where(F.col("_row").isNotNull()))        # nothing is evaluated after the last time
    needed = (F.col("_row.hold_seconds") / step).cast("int") + 1
    return counted.select("rule", "window_end", *[F.col("_row")[c].alias(c) for c in names],
                          (F.col("_row.holds") & (F.col("_votes") >= needed)).alias("firing")).select(
        *conditions.columns, "firing")


@dataclass(frozen=True)
class AlertRules:
    """Thresholds, lookbacks and hold times in seconds."""

    # Alert thresholds, hold times and lookbacks
    failure_ratio: float = 0.05
    failure_ratio_hold: int = 300
    dead_letter_hold: int = 600
    latency: float = 1.0
    latency_hold: int = 600
    consumer_lag: int = 1000
    consumer_lag_hold: int = 600
    review_backlog: int = 20
    review_backlog_hold: int = 900
    silence_hold: int = 1800
    short_lookback: int = 300
    dead_letter_lookback: int = 600
    silence_lookback: int = 900
    floor: float = 0.001


def alerts(outcomes: DataFrame, gauges: DataFrame, lag_edges: list[float], rules: AlertRules = AlertRules(),
           step: int = 60, extra: int = 0) -> DataFrame:
    """(rule, window_end, value, firing) at every evaluation time.

    ``gauges`` has (gauge, window_end, value) rows for ``consumer_lag`` and ``review_backlog``, one per gauge and
    time (the greatest counts). Latency is the ingest lag of stored events. All lookbacks are sums of one
    aggregate to a wide row per evaluation time; the rules are a table applied to that row.
    """
    r, lags = rules, [f"_le{i}" for i in range(len(lag_edges) + 1)]
    # the only pass over the outcomes; one row per step is left
    steps = cut_lineage(_steps(outcomes, step, lag_edges))
    wide = _wide(steps, _spine(steps, step, extra), gauges, {
        "received": ("received", r.short_lookback), "failed": ("failed", r.short_lookback),
        "dead": ("dead_lettered", r.dead_letter_lookback), "heard": ("received", r.silence_lookback),
        **{c: (c, r.short_lookback) for c in lags}}, ("consumer_lag", "review_backlog"), step)
    value, never = F.col("value"), F.lit(False)
    # rule, value, condition on the value, hold time. The names
    table = (
        ("EventProcessingFailureRateHigh", ratio_floor(
            _per_second(F.col("failed"), r.short_lookback), _per_second(F.col("received"), r.short_lookback), r.floor),
         lambda v: v > r.failure_ratio, r.failure_ratio_hold),
        ("DeadLetterRateElevated", _per_second(F.col("dead"), r.dead_letter_lookback), lambda v: v > 0, r.dead_letter_hold),
        ("EventProcessingLatencyHigh", quantile_of([F.col(c) for c in lags], lag_edges, F.lit(0.99)),
         lambda v: v > r.latency, r.latency_hold),
        ("ConsumerLagGrowing", F.col("consumer_lag"), lambda v: v > r.consumer_lag, r.consumer_lag_hold),
        ("FailedEventsAwaitingReview", F.col("review_backlog"), lambda v: v > r.review_backlog, r.review_backlog_hold),
        ("NoEventsReceived", _per_second(F.col("heard"), r.silence_lookback), lambda v: v == 0, r.silence_hold),
    )
    each = F.array(*[F.struct(F.lit(name).alias("rule"), v.cast("double").alias("value"),
                              F.coalesce(holds(v.cast("double")), never).alias("holds"), F.lit(hold).alias("hold_seconds"))
                     for name, v, holds, hold in table])
    conditions = wide.select("window_end", F.explode(each).alias("_c")).select("_c.rule", "window_end", "_c.value",
                                                                               "_c.holds", "_c.hold_seconds")
    return sustained(conditions, step).select("rule", "window_end", "value", "firing")


def _wide(steps: DataFrame, spine: DataFrame, gauges: DataFrame, sums: dict, readings: tuple[str, ...], step: int) -> DataFrame:
    """One row per time of ``spine``: for each name in ``sums`` the total of a metric over its lookback, and the
    gauge readings of that time. A step is spread over the longest lookback; shorter ones leave out its old part."""
    longest = max(width for _, width in sums.values())
    none = [F.lit(None).cast("double").alias(g) for g in readings]
    ages = F.explode(F.sequence(F.lit(0), F.lit(longest - step), F.lit(step))).alias("_age")
    spread = steps.select("*", ages).select(
        (F.col("_step") + F.make_dt_interval(secs=F.col("_age"))).alias("window_end"), F.lit(False).alias("_own"),
        *[F.when(F.col("_age") < width, F.col(metric)).otherwise(0).cast("long").alias(name)
          for name, (metric, width) in sums.items()], *none)
    zeros = [F.lit(0).cast("long").alias(name) for name in sums]
    times = spine.select("window_end", F.lit(True).alias("_own"), *zeros, *none)
    read = gauges.select("window_end", F.lit(False).alias("_own"), *zeros, *[
        F.when(F.col("gauge") == g, F.col("value")).cast("double").alias(g) for g in readings])
    return (spread.unionByName(times).unionByName(read).groupBy("window_end")
            .agg(F.max("_own").alias("_own"), *[F.sum(n).alias(n) for n in sums], *[F.max(g).alias(g) for g in readings])
            .where("_own").drop("_own"))


def lag_quantiles_by_window(outcomes: DataFrame, qs: list[float], edges: list[float], width: int = 300,
                            step: int = 60) -> DataFrame:
    """(window_end, quantile, seconds): quantiles of the ingest lag of stored events over the ``width`` seconds
    before each evaluation time. Histograms of steps are added up; a window without stored events has none."""
    names = [f"_le{i}" for i in range(len(edges) + 1)]
    windows = _lookback(_steps(outcomes, step, edges).select("_step", *names), width, step).where(F.col(names[-1]) > 0)
    rows = windows.select("window_end", *names, F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("quantile"))
    return rows.select("window_end", "quantile", quantile_of([F.col(n) for n in names], edges, F.col("quantile")).alias("seconds"))


def notification_rates(notifications: DataFrame, width: int = 300) -> DataFrame:
    """Notifications per second by type and window of their creation."""
    return (notifications.groupBy(F.window("created_at", f"{width} seconds").getField("start").alias("window_start"),
                                  "notification_type").agg(_per_second(F.count("*"), width).alias("rate")))


def skip_rates(skipped: DataFrame, width: int = 300) -> DataFrame:
    """Applied events without a new notification per second, by reason and window of reception."""
    return (skipped.groupBy(_tumbling(width).alias("window_start"), "reason")
            .agg(_per_second(F.count("*"), width).alias("rate")))


def _step_counts(outcomes: DataFrame, step: int, metrics: tuple[str, ...]) -> DataFrame:
    """Counts per step, stamped with the step's end."""
    return (outcomes.groupBy(F.window("received_at", f"{step} seconds").getField("end").alias("_step"))
            .agg(*[counters()[m].alias(m) for m in metrics]))


def _lookback(counts: DataFrame, width: int, step: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums over the ``width`` seconds before each ``window_end``."""
    metrics = [c for c in counts.columns if c not in ("_step", *by)]
    ends = F.sequence(F.col("_step"), F.col("_step") + F.make_dt_interval(secs=F.lit(width - step)),
                      F.make_dt_interval(secs=F.lit(step)))
    return (counts.select(*by, *metrics, F.explode(ends).alias("window_end"))
            .groupBy("window_end", *by).agg(*[F.sum(m).alias(m) for m in metrics]))


def _steps(outcomes: DataFrame, step: int, edges: list[float]) -> DataFrame:
    """Counters and lag buckets of the stored events, per step."""
    bucket = F.when(F.col("outcome").isin("APPLIED", "SUPERSEDED"), bucket_index(lag_seconds(), edges))
    return (outcomes.withColumn("_bucket", bucket)
            .groupBy(F.window("received_at", f"{step} seconds").getField("end").alias("_step"))
            .agg(*[counters()[m].alias(m) for m in ("received", "failed", "dead_lettered")],
                 *bucket_counts(edges)))
