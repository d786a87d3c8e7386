"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quaylake.functions.casting import quoted
from quaylake.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    covers: str
    run: Run
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under a name, with the operators it shows and its SQL."""

    def register(run: Run) -> Run:
        def configured(spark: SparkSession, folder: str) -> DataFrame:
            return run(configure(spark), folder)

        if name in REGISTERED:
            raise ValueError(f"{name} is registered twice")
        REGISTERED[name] = Query(covers, configured, sql)
        return run

    return register


def queries() -> dict[str, Run]:
    return {name: q.run for name, q in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTERED.items() if q.sql is not None}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; results are compared rounded."""
    return df.select(
        *[F.round(quoted(c), digits).alias(c) if c in columns else quoted(c) for c in df.columns]
    )


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as the zone-less type that the SQL has."""

    def plain(c: str) -> Column:
        return quoted(c).cast("timestamp_ntz").alias(c) if c in columns else quoted(c)

    return df.select(*[plain(c) for c in df.columns])


def decimals_as_text(df: DataFrame) -> DataFrame:
    """Decimals as text, which keeps every digit and shows the scale in any comparison."""
    decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.select(
        *[quoted(c).cast("string").alias(c) if c in decimals else quoted(c) for c in df.columns]
    )


def plain_name(name: str) -> str:
    """A column name that needs no quoting."""
    return name.replace(".", "_").replace("/", "_")


def plain_names(df: DataFrame) -> DataFrame:
    """The bronze names with dots and slashes need quoting in a select; results are compared without."""
    return df.toDF(*[plain_name(c) for c in df.columns])
