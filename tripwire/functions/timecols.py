"""Event-time arithmetic on microsecond longs.

Event time is carried as ``unix_micros`` inside the detectors: integer
arithmetic is exact, frames over a long ordering column are cheap, and
minute boundaries are the 1-minute slide of the sliding windows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwire.config import MICROS_PER_MINUTE

MINUTE = MICROS_PER_MINUTE
DAY = 1440 * MICROS_PER_MINUTE


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def floor_to(us: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above ``us`` (also for negative ``us``)."""
    return us - F.pmod(us, F.lit(step))


def minute_of(ts: Column) -> Column:
    """Start of the event's minute, in microseconds."""
    return floor_to(micros(ts), MINUTE)


def ts_of(us: Column) -> Column:
    return F.timestamp_micros(us)
