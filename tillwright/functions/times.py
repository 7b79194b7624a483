"""Dates, hours and slots.

On ``timestamp_ntz`` columns none of these depends on the session time zone.
``date_format`` would: it turns them into instants of that zone first, where an
hour can be missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.functions.texts import padded

# Slots are cut in the wall time of this zone (fixed value).
SLOT_ZONE = "America/Los_Angeles"


def utc_midnight(date: Column) -> Column:
    """The instant of UTC midnight of a date, in any session time zone."""
    return F.timestamp_seconds(F.unix_date(date) * F.lit(86400))


def date_text(moment: Column) -> Column:
    return moment.cast("date").cast("string")


def hour_text(moment: Column) -> Column:
    """Two-digit hour, so that hours compare as text."""
    return padded(F.hour(moment), 2)


def parse_date(text: Column) -> Column:
    """Date of year-month-day text, zeros optional; anything else is null, no error."""
    return F.try_to_date(text, "yyyy-M-d")


def local_time(utc: Column, zone: str = SLOT_ZONE) -> Column:
    """Wall time in ``zone`` of a UTC ``timestamp_ntz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def last_full_hour(utc: Column, zone: str = SLOT_ZONE) -> Column:
    """Wall time one hour before ``utc``: inside the newest complete hour."""
    return local_time(utc, zone) - F.expr("INTERVAL 1 HOUR")
