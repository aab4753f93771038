"""Times are TIMESTAMP_NTZ holding UTC; sessions run with the time zone UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of 0001-01-01 and 9999-12-31: anything outside is a damaged record.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def ntz(value: datetime | str) -> Column:
    """A fixed point in time as a literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_to_ntz(seconds: Column) -> Column:
    """Epoch seconds to UTC; 0, null and impossible values give null."""
    valid = seconds.between(_FIRST_SECOND, _LAST_SECOND) & (seconds != 0)
    return F.timestamp_seconds(F.when(valid, seconds)).cast("timestamp_ntz")


def iso_to_ntz(text: Column) -> Column:
    """ISO text, with or without an offset, to UTC; unreadable text gives null."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def hour_bucket(time: Column) -> Column:
    return F.date_trunc("hour", time).cast("timestamp_ntz")


def hours_between(earlier: Column, later: Column) -> Column:
    seconds = F.timestamp_diff("SECOND", earlier, later)
    return seconds.cast("double") / F.lit(3600.0)
