"""Structural validation of decoded events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model as M
from ..functions import blank, code_units

_WIRE = dict(M.WIRE_NAMES)
_REQUIRED = ("event_id", "schema_version", "shipment_id", "carrier_code", "event_time", "sequence_number")
_NOT_BLANK = ("tracking_number", "event_type", "correlation_id")
_POSITIVE = ("schema_version", "sequence_number")


def validate_events(parsed: DataFrame) -> DataFrame:
    """Adds ``violation``: NULL for a valid event, else the text of everything wrong with it.

    A missing body and an unsupported schema version are reported alone; otherwise all broken
    constraints are listed, sorted. Undecodable rows stay NULL here, they fail on their own.
    """
    checks = [(name, M.TEXT_NOT_NULL, F.col(name).isNull()) for name in _REQUIRED]
    checks += [(name, M.TEXT_NOT_BLANK, blank(F.col(name))) for name in _NOT_BLANK]
    checks += [(name, M.TEXT_POSITIVE, F.col(name) <= 0) for name in _POSITIVE]
    checks += [(name, M.TEXT_SIZE % limit,
                # a string of at most limit/2 characters cannot be over the limit
                (F.length(name) > limit // 2) & (code_units(F.col(name)) > limit))
               for name, limit in M.MAX_LENGTHS]
    # sort_array and array_join (which skips NULLs) compile; lambda-based array functions do not
    broken = F.sort_array(F.array(*[
        F.when(failed, F.lit(f"{_WIRE[name]} {text}")) for name, text, failed in checks]))

    version = F.col("schema_version")
    violation = (
        F.when(version.isNull() | (version != M.SUPPORTED_SCHEMA_VERSION),
               F.format_string(M.TEXT_VERSION, F.coalesce(version.cast("string"), F.lit("null")),
                               F.lit(M.SUPPORTED_SCHEMA_VERSION)))
        # the list is only put together for rows with something wrong
        .when(_any([failed for _, _, failed in checks]),
              F.concat(F.lit(M.TEXT_INVALID), F.array_join(broken, ", ")))
    )
    if "payload_missing" in parsed.columns:
        violation = F.when(F.col("payload_missing"), F.lit(M.TEXT_MISSING)).otherwise(violation)
    if "malformed" in parsed.columns:
        violation = F.when(~F.col("malformed"), violation)
    return parsed.withColumn("violation", violation)


def _any(conditions):
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result
