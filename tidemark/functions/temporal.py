"""Time columns: tolerant parsing and whole-second arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PING_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def parse_ts(text: Column, pattern: str | None = None) -> Column:
    """Zone-less timestamp of a text column; NULL where it cannot be read."""
    parsed = F.try_to_timestamp(text) if pattern is None else F.try_to_timestamp(text, F.lit(pattern))
    return parsed.cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch (floor), for a UTC session."""
    return F.unix_seconds(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Difference of the two floored ends."""
    return epoch_seconds(end) - epoch_seconds(start)
