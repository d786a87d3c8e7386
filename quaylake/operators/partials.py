"""Measures that can be merged: those of a new day are added without reading the earlier days again.

A table of partial measures has one row per part (a set of keys) and combination of its keys: rows, filled
amounts, their sum, least and largest. Each is an ordinary partial aggregate, all parts from one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted
from quaylake.functions.measures import percentage
from quaylake.operators.grouping import MATCHED, largest_first

PART = "partial_of"
ROWS, FILLED, SUM, LOW, HIGH = "partial_rows", "partial_count", "partial_sum", "partial_min", "partial_max"

MERGED = {
    "rows": lambda: F.sum(ROWS),
    "count": lambda: F.sum(FILLED),
    "sum": lambda: F.sum(SUM),
    "mean": lambda: F.try_divide(F.sum(SUM), F.sum(FILLED)),
    "min": lambda: F.min(LOW),
    "max": lambda: F.max(HIGH),
}


def partial_measures(df: DataFrame, parts: Mapping[str, Sequence[str]], amount: str) -> DataFrame:
    """Partial measures of `amount` by the keys of every part; the keys of other parts are null in a part's rows."""
    keys = list(dict.fromkeys(k for part in parts.values() for k in part))
    if taken := {PART, ROWS, FILLED, SUM, LOW, HIGH} & set(keys):
        raise ValueError(f"keys with the names of measures: {sorted(taken)}")
    label, value = F.lit(None).cast("string"), quoted(amount)
    for name, part in parts.items():
        absent = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in part)
        label = F.when(F.grouping_id() == absent, name).otherwise(label)
    grouped = df.groupingSets([[quoted(k) for k in part] for part in parts.values()], *[quoted(k) for k in keys])
    return grouped.agg(
        label.alias(PART), F.count(F.lit(1)).alias(ROWS), F.count(value).alias(FILLED), F.sum(value).alias(SUM),
        F.min(value).alias(LOW), F.max(value).alias(HIGH),
    )


def merged_by(
    partials: DataFrame, part: str, key: str, measures: Mapping[str, str], largest: str | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """Measures by the key of a part, as `grouping.measure_by` gives them over all rows."""
    of_part = partials.filter(F.col(PART) == part)
    kept = of_part if null_keys else of_part.filter(quoted(key).isNotNull())
    grouped = kept.groupBy(quoted(key)).agg(*merged(measures))
    return grouped if largest is None else grouped.orderBy(*largest_first(largest, key))


def merged(measures: Mapping[str, str]) -> list[Column]:
    """Aggregates over partial measures for an output-name -> measure map."""
    return [MERGED[kind]().alias(name) for name, kind in measures.items()]


def merged_summary(partials: DataFrame, part: str, status: str, matched: str = MATCHED) -> DataFrame:
    """As `grouping.match_summary`, from the part by status."""
    rows = F.coalesce(F.sum(ROWS), F.lit(0))
    is_matched = F.coalesce(F.sum(F.when(quoted(status) == matched, F.col(ROWS))), F.lit(0))
    return partials.filter(F.col(PART) == part).agg(
        rows.alias("total_registros"), F.sum(SUM).alias("total_valor"), is_matched.alias("matched"),
        percentage(is_matched, rows).alias("taxa_match"),
    )
