"""Nested columns to flat ones, names and order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.functions.casting import literal_name, quoted, to_timestamp_or_null
from quaylake.functions.measures import scaled


def expand_record(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Fields of a struct column as columns at the end (field -> new name); the struct goes."""
    rest = [literal_name(c) for c in df.columns if c != column]
    record = literal_name(column)
    return df.select(*rest, *[F.col(f"{record}.{literal_name(f)}").alias(n) for f, n in fields.items()])


def explode_list(df: DataFrame, column: str) -> DataFrame:
    """One row per element; an empty or null list leaves one row with null."""
    return df.withColumn(column, F.explode_outer(quoted(column)))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def reorder_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The listed columns that exist, then the rest in their order."""
    given = df.columns
    listed = [c for c in first if c in given]
    return df.select(*[literal_name(c) for c in listed + [c for c in given if c not in listed]])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns})


def journey_measures(df: DataFrame) -> DataFrame:
    """Parsed enter/leave times, minutes and kilometres beside their sources; null without source."""

    def source(name: str) -> Column:
        return quoted(name) if name in df.columns else F.lit(None).cast("string")

    return df.withColumns(
        {
            "entrada": to_timestamp_or_null(source("enterTime")),
            "saida": to_timestamp_or_null(source("leaveTime")),
            "duracao_minutos": scaled(source("duration"), 60),
            "distancia_km": scaled(source("distance"), 1000),
        }
    )
