"""Report numbers kept by ingestion day: a new day is merged in, earlier days are not read again."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted
from quaylake.functions.time import day_of
from quaylake.operators.partials import merged_by, merged_summary, partial_measures
from quaylake.plans.reports import DEFAULT, TOP_SUPPLIERS, Columns
from quaylake.sources.writers import overwrite_parquet

STORED_DAY = "measured_day"
CREATED_DAY = "created_day"


def store_day(
    df: DataFrame, folder: str, day: date, columns: Columns = DEFAULT, ingested: str = "_ingestion_date"
) -> DataFrame:
    """Put the partial measures of the rows ingested on `day` into `folder`, in the place of earlier ones of that
    day, and return them. The day is a filter that reaches the scan: on a table partitioned by it, or ordered by
    it (`writers.overwrite_ordered`), the other days are not read."""
    rows = df.filter(quoted(ingested) == F.lit(day.isoformat()).cast(df.schema[ingested].dataType))
    c = columns
    rows = rows.select(quoted(c.status), quoted(c.supplier), quoted(c.amount), day_of(quoted(c.created)).alias(CREATED_DAY))
    parts = {"status": [c.status], "supplier": [c.supplier], "day": [CREATED_DAY]}
    return overwrite_parquet(partial_measures(rows, parts, c.amount), f"{folder}/{STORED_DAY}={day.isoformat()}")


def stored_days(spark: SparkSession, folder: str) -> DataFrame:
    """Partial measures of all days."""
    return spark.read.option("basePath", folder).parquet(f"{folder}/{STORED_DAY}=????-??-??")


@dataclass(frozen=True)
class MergedDashboard:
    """The numbers of `reports.Dashboard` and the status values of the console report, from partial measures."""

    partials: DataFrame
    columns: Columns = DEFAULT

    def status(self) -> DataFrame:
        return merged_by(self.partials, "status", self.columns.status, {"count": "rows"}, "count")

    def status_value(self) -> DataFrame:
        return merged_by(self.partials, "status", self.columns.status, {"total": "sum", "media": "mean"}, "total")

    def top_suppliers(self) -> DataFrame:
        wanted = {"count": "rows", "total": "sum"}
        supplier = self.columns.supplier
        return merged_by(self.partials, "supplier", supplier, wanted, "total", null_keys=False).limit(TOP_SUPPLIERS)

    def daily(self) -> DataFrame:
        days = merged_by(self.partials, "day", CREATED_DAY, {"quantidade": "rows", "valor": "sum"})
        return days.withColumnRenamed(CREATED_DAY, "data").orderBy(F.col("data").asc_nulls_last())

    def summary(self) -> DataFrame:
        return merged_summary(self.partials, "status", self.columns.status, self.columns.matched)
