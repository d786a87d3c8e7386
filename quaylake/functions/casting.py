"""Strict and tolerant type changes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_name(name: str) -> str:
    """A column name to pass to `select`, also when it holds dots or slashes."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by its literal name."""
    return F.col(literal_name(name))


def strict_casts(types: Mapping[str, str]) -> list[Column]:
    """One plain cast per column, in order; a value that does not fit fails the job (ANSI)."""
    return [quoted(name).cast(kind).alias(name) for name, kind in types.items()]


def whole_number(value: Column, kind: str = "int", rounded: bool = False) -> Column:
    """Fractional number to a whole one: truncated as Spark's cast does, or rounded half up."""
    return (F.round(value) if rounded else value).cast(kind)


# A decimal number or an infinity, among blanks.
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def to_number(value: Column) -> Column:
    """Text to double, null when it is not a number.

    The form is tested first: Spark's parser also takes a Java type suffix ("12d"), and on other
    text it raises and catches an exception, which is slow where many values are bad.
    """
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def json_number(value: Column) -> Column:
    """As `to_number` for a JSON value (`VARIANT`); true and false are 1 and 0, a text "true" is null."""
    flag = F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    return F.coalesce(flag.cast("int").cast("double"), to_number(F.try_variant_get(value, "$", "string")))


def to_timestamp_or_null(value: Column, formats: Iterable[str] = ()) -> Column:
    """ISO text, or text in one of `formats`, to timestamp; null when no form fits.

    Each row is parsed for itself, so a column may mix formats.
    """
    text = value.cast("string")
    tries = [F.try_to_timestamp(text)]
    tries += [F.try_to_timestamp(text, F.lit(form)) for form in formats]
    return F.coalesce(*tries)


# The date at the beginning of ISO text.
OWN_DATE = r"^\s*([+-]?\d{4,6}-\d{1,2}-\d{1,2})"


def to_date_or_null(value: Column, formats: Iterable[str] = ()) -> Column:
    """Day of ISO text, or of text in one of `formats`; null when no form fits.

    Text with an offset keeps the day that it names itself: an evening at -03:00 is not the next day.
    """
    text = value.cast("string")
    own = F.when(F.try_to_timestamp(text).isNotNull(), F.regexp_extract(text, OWN_DATE, 1).try_cast("date"))
    return F.coalesce(own, to_timestamp_or_null(text, formats).cast("date"))


def to_text(value: Column) -> Column:
    return value.cast("string")
