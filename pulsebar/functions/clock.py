"""Time as zone-free wall clocks (TIMESTAMP_NTZ) and epoch seconds (BIGINT).

Nothing here reads the session time zone, so a job gives the same rows
whatever zone its session runs in.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsebar.layout import BUCKET_SECONDS, KEYS_PER_SECOND

DAY_SECONDS = 86_400
_EPOCH = datetime(1970, 1, 1)
_FIRST, _LAST = (int((end - _EPOCH).total_seconds()) for end in (datetime.min, datetime(9999, 12, 31, 23, 59, 59)))
# Date-time text as the feeds write it; one-digit parts are accepted. Years end
# where a date, or the same date in another zone, would no longer fit four digits.
_CIVIL_TEXT = r"^[1-8]\d{3}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"


def civil_seconds(ts: Column) -> Column:
    """Seconds from 1970-01-01 00:00 to a wall-clock time, read as UTC.

    On TIMESTAMP_NTZ this is one division whatever the session zone. Fractions
    are cut off; feed times have none.
    """
    return F.unix_timestamp(ts)


def epoch_seconds(ts: Column, zone: str = "UTC") -> Column:
    """Epoch seconds of a wall-clock time observed in ``zone``."""
    if zone != "UTC":
        ts = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    return civil_seconds(ts)


def civil_time(seconds: Column, zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of an epoch second."""
    ts = civil_literal(0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    if zone != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return ts


def now(zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` when the query or micro-batch starts, to the second."""
    return civil_time(F.unix_seconds(F.current_timestamp()), zone)


def parse_civil(text: Column) -> Column:
    """Wall-clock time from ``yyyy-MM-dd HH:mm:ss`` text, null if it is none."""
    return F.when(text.rlike(_CIVIL_TEXT), text.try_cast("timestamp_ntz"))


def civil_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a wall-clock time."""
    return F.substring(ts.cast("string"), 1, 19)


def bucket_start(seconds: Column, width: int = BUCKET_SECONDS) -> Column:
    """First second of the bucket that holds an epoch second."""
    return seconds - F.pmod(seconds, F.lit(width).cast("bigint"))


def key_second(row_key: Column) -> Column:
    """Epoch second of a raw row key."""
    return F.call_function("div", row_key, F.lit(KEYS_PER_SECOND).cast("bigint"))


def day_of(seconds: Column) -> Column:
    """UTC date of an epoch second."""
    start = bucket_start(seconds, DAY_SECONDS)
    days = F.call_function("div", start, F.lit(DAY_SECONDS).cast("bigint"))
    return F.date_from_unix_date(days.cast("int"))


def civil_literal(seconds: int) -> Column:
    """Wall-clock literal (UTC) of an epoch second, fit for scan pushdown."""
    text = (_EPOCH + timedelta(seconds=seconds)).isoformat(sep=" ")
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def between_seconds(ts: Column, start: int, stop: int) -> Column:
    """``start <= ts < stop`` on the stored column itself, so it reaches the scan."""
    return (ts >= civil_literal(start)) & (ts < civil_literal(stop))


def utc_date(seconds: int) -> date:
    """UTC date of an epoch second, on the driver; the first or last date there is beyond them."""
    seconds = min(max(seconds, _FIRST), _LAST)
    return (_EPOCH + timedelta(seconds=seconds)).date()


def days_around(day: date, width: int = BUCKET_SECONDS) -> list[date]:
    """UTC dates of the buckets that hold a second of a date."""
    first = (day - _EPOCH.date()).days * DAY_SECONDS
    last = first + DAY_SECONDS - 1
    start, stop = utc_date(first - first % width), utc_date(last - last % width + width - 1)
    return [start + timedelta(days=k) for k in range((stop - start).days + 1)]
