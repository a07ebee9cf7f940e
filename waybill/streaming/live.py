"""Rates on a stream. The only place with a watermark: tables never drop late events, but a
dashboard window has to close."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reports import counters


def live_rates(outcomes: DataFrame, width: str = "5 minutes", slide: str | None = None,
               watermark: str = "10 minutes") -> DataFrame:
    """Counters per window of reception time, on a streaming (or static) outcomes DataFrame."""
    window = F.window("received_at", width, slide) if slide else F.window("received_at", width)
    return (outcomes.withWatermark("received_at", watermark).groupBy(window)
            .agg(*[c.alias(name) for name, c in counters().items()])
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    *counters()))
