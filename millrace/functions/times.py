"""Date and time expressions. Epoch arithmetic assumes the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the format of stamps in the archives.
ARCHIVE_STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MICROS = 1_000_000
# Timestamps count microseconds in 64 bits.
MOST_SECONDS = (2**63 - 1) // MICROS


def archive_stamp(stamp: Column) -> Column:
    """Timestamp from archive text; null when malformed."""
    return F.try_to_timestamp(stamp, F.lit(ARCHIVE_STAMP_FORMAT))


def epoch_seconds_to_timestamp(epoch: Column) -> Column:
    """Timestamp from epoch seconds given as text or number; null when not a whole number or out of range."""
    seconds = epoch.try_cast("bigint")
    fits = seconds.between(-MOST_SECONDS, MOST_SECONDS)
    return F.timestamp_seconds(F.when(fits, seconds))


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def micros_between(start: Column, end: Column) -> Column:
    return _micros(end) - _micros(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with fractions; negative when end precedes start."""
    return micros_between(start, end) / F.lit(float(MICROS))


def tumbling_index(moment: Column, seconds: int) -> Column:
    """Index of the fixed window holding the moment: floor(epoch / seconds), in whole numbers.

    Rounding down through pmod keeps moments before 1970 in the right window.
    """
    micros = _micros(moment)
    width = F.lit(seconds * MICROS)
    return F.call_function("div", micros - F.pmod(micros, width), width)
