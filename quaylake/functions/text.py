"""Text cleaning, tests, tokens and display formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(value: Column) -> Column:
    """Trimmed text; empty becomes null."""
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def tokens(line: Column) -> Column:
    """White-space separated tokens; an empty line has none."""
    trimmed = F.trim(F.regexp_replace(line, r"\s+", " "))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def token_from_end(line: Column, position: int, at_least: int = 0) -> Column:
    """Token counted from the end (1 is the last); null for lines with fewer than `at_least` tokens."""
    parts = tokens(line)
    return F.when(F.size(parts) >= at_least, F.try_element_at(parts, F.lit(-position)))


def prefix_category(name: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Category of the first prefix in `rules` that `name` starts with."""
    category = F.lit(default)
    for prefix, label in reversed(rules):
        category = F.when(name.startswith(prefix), F.lit(label)).otherwise(category)
    return category


def grouped_digits(value: Column, decimals: int = 2) -> Column:
    """1234.5 -> '1,234.50'."""
    return F.format_number(value, decimals)


def left_aligned(value: Column, width: int) -> Column:
    """Padded on the right to `width`; longer text is kept whole."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.rpad(text, width, " "))


def right_aligned(value: Column, width: int) -> Column:
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, " "))


def shortened(value: Column, length: int) -> Column:
    """First `length` characters, for display only."""
    return F.substring(value, 1, length)
