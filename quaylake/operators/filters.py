"""Row filters that need more than one expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from quaylake.functions.casting import quoted


def keys_present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which no key is null.

    One IS NOT NULL per key, which the Parquet scan takes over; `dropna` would count the
    non-null keys in an expression that no scan understands.
    """
    return df.filter(reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys]))
