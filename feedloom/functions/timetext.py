"""Canonical timestamp text ``yyyy-MM-ddTHHmmss``: wall-clock time, sorts by time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zone whose wall-clock time the feeds carry.
FEED_ZONE = "Asia/Singapore"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical(c) -> Column:
    """Canonical text of ISO-8601 text or a timestamp; the written offset is ignored.

    Works on text slices, so the session time zone plays no part. Bad text gives NULL.
    """
    s = F.substring(_col(c).try_cast("timestamp_ntz").cast("string"), 1, 19)
    return F.translate(s, " :", "T")


def to_ntz(c) -> Column:
    """Canonical text to TIMESTAMP_NTZ; anything else gives NULL."""
    c = _col(c)
    return F.concat(
        F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 2), F.lit(":"),
        F.substring(c, 14, 2), F.lit(":"), F.substring(c, 16, 2),
    ).try_cast("timestamp_ntz")


def date_part(c) -> Column:
    return F.substring(_col(c), 1, 10)


def hour_part(c) -> Column:
    return F.substring(_col(c), 12, 2)


def minute_part(c) -> Column:
    return F.substring(_col(c), 14, 2)


def hhmm_part(c) -> Column:
    return F.substring(_col(c), 12, 4)


def day(c) -> Column:
    """DATE of canonical text."""
    return date_part(c).try_cast("date")


def bound(date: str, hour: int) -> str:
    """Range bound; hour 24 sorts after every time of the day."""
    if not 0 <= hour <= 24:
        raise ValueError(f"hour out of range: {hour}")
    return f"{date}T{hour:02d}0000"


def bound_col(date, hour) -> Column:
    return F.format_string("%sT%02d0000", _col(date), _col(hour))


def local_now(zone: str = FEED_ZONE) -> Column:
    """Canonical text of the current wall-clock time in ``zone``."""
    return canonical(F.convert_timezone(
        F.current_timezone(), F.lit(zone), F.current_timestamp().cast("timestamp_ntz")))


def as_date(value: dt.date | str | None, zone: str = FEED_ZONE) -> Column:
    """``as_of`` argument: a date, its text, or today in the feeds' zone."""
    if value is None:
        return day(local_now(zone))
    return F.lit(str(value)).cast("date")
