"""Dates and times, all in UTC."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def created_timestamp(epoch_seconds: Column) -> Column:
    """Epoch seconds to TIMESTAMP without a detour over zone-dependent text."""
    return F.timestamp_seconds(epoch_seconds)


def epoch_micros(value: datetime) -> int:
    """A datetime without a zone means UTC, whatever the zone of the host."""
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def as_timestamp(value) -> Column:
    """A TIMESTAMP column from a datetime, an ISO text or a column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        return F.timestamp_micros(F.lit(epoch_micros(value)))
    return F.lit(value).cast("timestamp")


def record_age_days(created: Column, as_of: Column) -> Column:
    """Calendar days between the two dates (23:59 to 00:01 counts as one)."""
    return F.datediff(as_of, created)


def to_iso(ts: Column) -> Column:
    """ISO-8601 text with ``Z``; fractions of a second are cut off."""
    return F.date_format(ts, ISO_SECONDS)


def from_iso(text: Column) -> Column:
    """Inverse of :func:`to_iso`; NULL for other text. Accepts fractions and offsets."""
    return F.try_to_timestamp(text)


def hours_between(end: Column, start: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3600000000.0)
