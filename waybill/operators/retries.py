"""The delay queue of automatic retries: when a waiting event is due, and how often it was tried.

A failure that a retry may help is tried again after growing waits. Times are the feed's. An event is in
the queue with the number of tries it has had and the time of the next; what is due, how many tries have
passed and whether any is left follows from its first failure and the time now.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import model as M


def waits_ms(initial_ms: int = M.RETRY_INITIAL_MS, multiplier: float = M.RETRY_MULTIPLIER,
             max_ms: int = M.RETRY_MAX_MS, retries: int = M.RETRY_LIMIT) -> list[int]:
    """Waiting time before each retry: exponential, with a ceiling."""
    return [min(int(initial_ms * multiplier ** n), max_ms) for n in range(retries)]


def due_ms(waits: list[int]) -> list[int]:
    """When each retry is due, after the first failure."""
    return [sum(waits[:n + 1]) for n in range(len(waits))]


def retries_passed(first_failed: Column, now: Column, due: list[int]) -> Column:
    """How many retries have come due by ``now``."""
    elapsed = F.unix_micros(now) - F.unix_micros(first_failed)
    passed = F.lit(0)
    for ms in due:
        passed = passed + (elapsed >= ms * 1000).cast("int")
    return passed


def next_due(first_failed: Column, passed: Column, due: list[int]) -> Column:
    """When the retry after the first ``passed`` ones is due; NULL if there is none."""
    if not due:
        return F.lit(None).cast("timestamp")
    wait = F.try_element_at(F.array(*map(F.lit, due)), passed + 1)
    return F.timestamp_micros(F.unix_micros(first_failed) + wait.cast("long") * 1000)


def tries(passed: Column, tried: Column) -> Column:
    """Tries of an event that has just been looked at, the first delivery included. ``tried`` is what it had
    before: an event that is released before its retry is due is tried then."""
    return F.when(tried.isNull(), passed + 1).otherwise(F.greatest(passed + 1, tried + 1))
