"""Silver to gold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from quaylake.operators.grouping import row_volume
from quaylake.sources.readers import named_table
from quaylake.sources.writers import replace_view, store_view, swap_table

# Names of the source schema, the sources, their staging views and the result.
SOURCE_SCHEMA = "public"
SALES_SOURCE = "silver_pcnfsaid"
USERS_SOURCE = "silver_pcusuario"
VOLUME_COLUMN = "qtd_linhas_pcnfsaid"
SALES_SUMMARY = "gold_vendas_resumo"


def staging(spark: SparkSession, source: str, schema: str = SOURCE_SCHEMA) -> DataFrame:
    """A source table behind a view of its own."""
    return replace_view(named_table(spark, schema, source), f"stg_{source}")


def staging_views(spark: SparkSession, schema: str = SOURCE_SCHEMA) -> dict[str, DataFrame]:
    """Both sources behind views of the catalog, which other sessions can read."""
    return {
        source: store_view(spark, f"stg_{source}", f"SELECT * FROM `{schema}`.`{source}`")
        for source in (SALES_SOURCE, USERS_SOURCE)
    }


def sales_summary(sales: DataFrame, as_of: date | None = None) -> DataFrame:
    """Number of sales lines under the reference date."""
    return row_volume(sales, VOLUME_COLUMN, as_of)


def build_sales_summary(
    spark: SparkSession, schema: str = SOURCE_SCHEMA, as_of: date | None = None,
    table: str = SALES_SUMMARY, path: str | None = None,
) -> DataFrame:
    """Source, staging view and summary table; the table is replaced when it is complete."""
    return swap_table(sales_summary(staging(spark, SALES_SOURCE, schema), as_of), table, path)
