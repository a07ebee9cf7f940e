"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import WIRE_NAMES

# what counts as white space at the edges of a text: space and all control characters below it
_SPACE = "".join(map(chr, range(0x21)))
_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def blank(c: Column) -> Column:
    """NULL, empty, or nothing but spaces and control characters."""
    return c.isNull() | ~c.rlike(r"[^\x00-\x20]")


def normalized_code(c: Column) -> Column:
    """Carrier codes compare without surrounding white space and case."""
    return F.upper(F.btrim(c, F.lit(_SPACE)))


def code_units(c: Column) -> Column:
    """Length in UTF-16 code units, the unit the size limits are stated in."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def bounded(c: Column, limit: int) -> Column:
    """Text of more than ``limit`` UTF-16 code units keeps its first ``limit - 3`` and ends in dots.

    A character of two units is never cut in half: it goes whole."""
    units = F.encode(c, "UTF-16BE")
    size = 2 * (limit - 3)
    high = F.conv(F.hex(F.substring(units, size - 1, 1)), 16, 10).cast("int").between(0xD8, 0xDB)
    kept = F.decode(F.substring(units, F.lit(1), F.when(high, size - 2).otherwise(size)), "UTF-16BE")
    return F.when(code_units(c) > limit, F.concat(kept, F.lit("..."))).otherwise(c)


def digest(*parts: Column) -> Column:
    """Deterministic surrogate id in UUID form, so a rerun of a batch produces the same rows."""
    hashed = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(hashed, start, length) for start, length in cuts])


def ratio_floor(numerator: Column, denominator: Column, floor: float) -> Column:
    return numerator / F.greatest(denominator, F.lit(floor))


def wire_json(df: DataFrame) -> Column:
    """The event's columns in their wire form; absent optionals are left out of the JSON."""
    fields = []
    for name, wire in WIRE_NAMES:
        c = F.col(name)
        if name == "event_time":
            # the instant in UTC, whatever the session's zone
            c = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz")), _INSTANT)
        fields.append(c.alias(wire))
    return F.to_json(F.struct(*fields))
