"""Timestamps, dates and run instants."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAPSHOT_LABEL = "yyyyMMdd_HHmmss"


def iso_to_timestamp(value: Column) -> Column:
    """ISO text to timestamp by its first 19 characters: fraction and offset are dropped.

    Strict; the session zone is UTC.
    """
    seconds = F.substring(value.cast("string"), 1, 19)
    return F.replace(seconds, F.lit("T"), F.lit(" ")).cast("timestamp")


def utc_instant(as_of: datetime | None) -> datetime:
    """`as_of` in UTC, or now; a time without zone is taken as UTC."""
    if as_of is None:
        return datetime.now(timezone.utc)
    return as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None else as_of.astimezone(timezone.utc)


def processing_time(as_of: datetime | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(utc_instant(as_of)).cast("timestamp")


def reference_date(as_of: date | None = None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def day_of(value: Column) -> Column:
    return F.to_date(value)


def snapshot_label(value: Column) -> Column:
    """20240131_235959 for 2024-01-31 23:59:59."""
    return F.date_format(value, SNAPSHOT_LABEL)
