"""Timestamps and durations from API strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_timestamp(c: Column, on_bad: str = "raise") -> Column:
    """ISO-8601 text with zone to timestamp; ``on_bad='null'`` keeps rows with malformed text."""
    if on_bad not in ("raise", "null"):
        raise ValueError("on_bad must be 'raise' or 'null'")
    return F.to_timestamp(c) if on_bad == "raise" else F.try_to_timestamp(c)


def iso_duration_seconds(c: Column) -> Column:
    """Seconds of an ISO-8601 duration such as ``P1DT2H3M4S``; NULL where the text is no duration."""
    def part(pattern: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("bigint"), F.lit(0))

    total = part(r"^P(\d+)D") * 86400 + part(r"T(?:\d+H)?(?:\d+M)?(\d+)S$")
    total = total + part(r"T(\d+)H") * 3600 + part(r"T(?:\d+H)?(\d+)M") * 60
    return F.when(c.rlike(r"^P(?=.)(\d+D)?(T(?=\d)(\d+H)?(\d+M)?(\d+S)?)?$"), total)
