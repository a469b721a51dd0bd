"""Python date-times as UTC instants, whatever zone the driver runs in."""

from __future__ import annotations

from datetime import date, datetime, time, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_utc(at: datetime) -> datetime:
    """Aware UTC; a naive time is taken as UTC."""
    if at.tzinfo is None:
        return at.replace(tzinfo=timezone.utc)
    return at.astimezone(timezone.utc)


def start_of(day: date) -> datetime:
    return datetime.combine(day, time.min, timezone.utc)


def instant(at: datetime) -> Column:
    return F.lit(as_utc(at))


def utc_now() -> datetime:
    return datetime.now(timezone.utc)
