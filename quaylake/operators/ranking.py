"""Top groups and top rows.

Each is an ORDER BY with a LIMIT, which Spark runs as a bounded top-n per task and one merge.
Equal measures are ordered by further columns, so the cut is the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted
from quaylake.operators.grouping import largest_first, measure_by


def top_groups(
    df: DataFrame, key: str, amount: str | None, measures: Mapping[str, str], by: str, n: int
) -> DataFrame:
    """The n groups with the largest measure; groups without a key are left out."""
    return measure_by(df, key, amount, measures, largest=by, null_keys=False).limit(n)


def top_rows(df: DataFrame, amount: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The n rows with the largest amount; `ties` (an id, or the input order) settles equals."""
    return df.orderBy(*largest_first(amount, *ties)).limit(n)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*[quoted(c).asc_nulls_last() for c in order]).limit(n)


def sorted_by_amount(df: DataFrame, amount: str, ties: Sequence[str]) -> DataFrame:
    """Whole table, largest first. The tie columns also let the range partitioning cut through
    a run of equal amounts, so that one hot value does not end up in one task."""
    return df.orderBy(*largest_first(amount, *ties))


def sorted_ascending(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending with nulls last, as the SQL engines sort (Spark's default is nulls first)."""
    return df.orderBy(*[F.asc_nulls_last(quoted(c)) for c in columns])
