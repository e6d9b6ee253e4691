"""Event times and retention durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An instant needs a date, hours, minutes, seconds and a literal Z. The guard is
# needed because Spark would also take offsets, bare dates and a space.
_INSTANT = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{0,9})?[Zz]$"

# Seconds per duration unit.
_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def event_time_seconds(text: Column) -> Column:
    """ISO instant -> epoch seconds, rounded down; NULL when it is not one."""
    return F.when(
        text.rlike(_INSTANT), F.unix_seconds(F.try_to_timestamp(F.upper(text)))
    )


def retention_seconds(duration: Column) -> Column:
    """``5d`` -> 432000; NULL when it is no number followed by s, m, h, d or w."""
    pattern = r"^([0-9]+)([smhdw])$"
    unit = F.regexp_extract(duration, pattern, 2)
    scale = F.lit(None).cast("bigint")
    for symbol, seconds in _UNIT_SECONDS.items():
        scale = F.when(unit == symbol, F.lit(seconds).cast("bigint")).otherwise(scale)
    return F.regexp_extract(duration, pattern, 1).try_cast("bigint") * scale


# Years 1 to 9999: outside them a day has no eight digits.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def utc_day(seconds: Column) -> Column:
    """Epoch seconds -> ``yyyyMMdd`` (the session runs in UTC); NULL outside years 1-9999."""
    return F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND),
        F.date_format(F.timestamp_seconds(seconds), "yyyyMMdd"),
    )
