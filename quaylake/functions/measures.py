"""Ratios and unit changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """part / whole * 100, null when there is no whole."""
    return F.try_divide(part, whole) * F.lit(100)


def scaled(value: Column, divisor: float) -> Column:
    """value / divisor as double."""
    return value.cast("double") / F.lit(float(divisor))


def kilobytes(length: Column) -> Column:
    return scaled(length, 1024)


def megabytes(length: Column) -> Column:
    return scaled(length, 1024 * 1024)
