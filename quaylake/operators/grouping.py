"""Counts, sums and other measures, by group or over a whole table.

Every measure is a partial aggregate, so a hot group is reduced before the shuffle and
one task never sees its rows. Groups with a null key stay unless `null_keys=False`.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted
from quaylake.functions.measures import percentage
from quaylake.functions.time import day_of, reference_date

MEASURES = {
    "rows": lambda amount: F.count(F.lit(1)),
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
}

# Status of a reconciled row and of the two kinds left open.
MATCHED = "MATCHED"
UNMATCHED = "UNMATCHED"
UNMATCHED_MOVEMENT = "UNMATCHED_MOVEMENT"


def measured(amount: str | None, measures: Mapping[str, str]) -> list[Column]:
    """Aggregates for an output-name -> measure map."""
    value = None if amount is None else quoted(amount)
    return [MEASURES[kind](value).alias(name) for name, kind in measures.items()]


def measure_by(
    df: DataFrame,
    key: str,
    amount: str | None,
    measures: Mapping[str, str],
    largest: str | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """Measures of `amount` by `key`; with `largest` sorted by that measure, then by key."""
    kept = df if null_keys else df.filter(quoted(key).isNotNull())
    grouped = kept.groupBy(quoted(key)).agg(*measured(amount, measures))
    return grouped if largest is None else grouped.orderBy(*largest_first(largest, key))


def largest_first(measure: str, *ties: str) -> list[Column]:
    """Descending measure with a fixed order among equals."""
    return [quoted(measure).desc_nulls_last(), *[quoted(t).asc_nulls_last() for t in ties]]


def value_counts(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return measure_by(df, key, None, {name: "rows"}, largest=name, null_keys=False)


def totals(df: DataFrame, amount: str, measures: Mapping[str, str]) -> DataFrame:
    """One row of measures."""
    return df.agg(*measured(amount, measures))


def within(df: DataFrame, amount: str, low: float, high: float) -> DataFrame:
    """Rows with low <= amount <= high."""
    return df.filter(quoted(amount).between(low, high))


def daily_series(
    df: DataFrame, instant: str, amount: str, day: str = "data",
    rows: str = "quantidade", total: str = "valor",
) -> DataFrame:
    """Rows and sum by day, oldest first, an unknown day last."""
    return (
        df.groupBy(day_of(quoted(instant)).alias(day))
        .agg(*measured(amount, {rows: "rows", total: "sum"}))
        .orderBy(quoted(day).asc_nulls_last())
    )


def match_summary(df: DataFrame, status: str, amount: str, matched: str = MATCHED) -> DataFrame:
    """Total rows, total value, matched rows and match rate in per cent, in one scan."""
    is_matched = F.count_if(quoted(status) == matched)
    return df.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.sum(quoted(amount)).alias("total_valor"),
        is_matched.alias("matched"),
        percentage(is_matched, F.count(F.lit(1))).alias("taxa_match"),
    )


def open_totals(
    df: DataFrame, status: str, amount: str,
    unmatched: str = UNMATCHED, also: tuple[str, ...] = (UNMATCHED_MOVEMENT,),
) -> DataFrame:
    """Rows and value of the unmatched category, and rows of it and its kin together."""
    is_open = quoted(status) == unmatched
    return df.agg(
        F.count_if(is_open).alias("unmatched"),
        F.coalesce(F.sum(F.when(is_open, quoted(amount))), F.lit(0.0)).alias("unmatched_valor"),
        F.count_if(quoted(status).isin(unmatched, *also)).alias("sem_match"),
    )


def row_volume(df: DataFrame, name: str, as_of: date | None = None) -> DataFrame:
    """Number of rows under a reference date."""
    return df.agg(F.count(F.lit(1)).alias(name)).select(
        reference_date(as_of).alias("data_referencia"), quoted(name)
    )
