"""Landed pages and database tables to bronze tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quaylake.functions.casting import json_number, quoted, to_date_or_null, to_number, to_timestamp_or_null
from quaylake.operators.profiling import observed_summary, summary_measures
from quaylake.operators.records import (
    LENIENT, PAGE_SIZE, field_types, inferred_schema, page_sequence, select_fields, struct_type,
    unwrap_row,
)
from quaylake.operators.reshape import (
    expand_record, explode_list, journey_measures, prefix_columns, rename_columns, reorder_columns,
)
from quaylake.operators.snapshots import MAX_SNAPSHOTS, newest_snapshots
from quaylake.plans.endpoints import ENDPOINTS, Endpoint
from quaylake.sources.writers import history, land, observed_snapshot


def flatten(records: DataFrame, endpoint: Endpoint) -> DataFrame:
    """Records of an endpoint as the flat, typed columns of its bronze table."""
    flat = select_fields(unwrap_row(records, strict=endpoint.strict_row), endpoint.fields)
    for column in endpoint.lists:
        flat = explode_list(flat, column)
    for column, fields in endpoint.records.items():
        flat = expand_record(flat, column, fields)
    kinds = dict(flat.dtypes)
    changes = {
        c: json_number(quoted(c)) if kinds[c] == "variant" else to_number(quoted(c)) for c in endpoint.numbers
    }
    changes |= {c: to_date_or_null(quoted(c)) for c in endpoint.dates}
    changes |= {c: to_timestamp_or_null(quoted(c)) for c in endpoint.timestamps}
    flat = rename_columns(flat.withColumns(changes) if changes else flat, endpoint.names)
    if endpoint.order:
        flat = reorder_columns(flat, endpoint.order)
    return prefix_columns(flat, endpoint.prefix) if endpoint.prefix else flat


def bronze_table(
    pages: DataFrame,
    name: str,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    runs: tuple[str, ...] = (),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bronze table of one of `ENDPOINTS` from its landed pages. Fields are text unless they are
    coerced; `types` gives some of them other types, and values that don't fit are null then."""
    endpoint = ENDPOINTS[name]
    if types:
        endpoint = replace(endpoint, fields={**endpoint.fields, **types})
    return flatten(page_sequence(pages, page_size, max_pages, runs), endpoint)


# The columns that stand for the two records of a journey.
JOURNEY_RECORDS = {
    "driver": {"id": "motorista_id", "name": "motorista_nome"},
    "vehicle": {"id": "veiculo_id", "code": "veiculo_codigo"},
}


def driver_journeys(
    pages: DataFrame,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    runs: tuple[str, ...] = (),
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Work journeys, read leniently, with every key the records have.

    The keys and their types are looked up by a pass over the records unless `fields` names them;
    name them for large inputs. Other nested keys stay nested.
    """
    records = page_sequence(pages, page_size, max_pages, runs, LENIENT)
    flat = select_fields(records, fields or journey_fields(records))
    for column, names in JOURNEY_RECORDS.items():
        if column in flat.columns:
            flat = expand_record(flat, column, names)
    return journey_measures(flat)


def journey_fields(records: DataFrame) -> dict[str, str]:
    """All keys seen, with the two records read for the members that become columns.

    A member keeps its type where every value of the record is an object, and is text elsewhere.
    """
    schema = inferred_schema(records)
    fields = field_types(schema)
    for column, names in JOURNEY_RECORDS.items():
        if column in fields:
            seen = schema[column].dataType
            members = field_types(seen) if isinstance(seen, StructType) else {}
            fields[column] = struct_type({n: members.get(n, "string") for n in names})
    return fields


def land_endpoint(
    pages: DataFrame, name: str, path: str, as_of: datetime | None = None,
    page_size: int = PAGE_SIZE, max_pages: int | None = None, runs: tuple[str, ...] = (),
) -> bool:
    """Write the bronze table of an endpoint; without records the old table stays."""
    if name == "driver_journeys":
        return land(driver_journeys(pages, page_size, max_pages, runs), path, as_of)
    return land(bronze_table(pages, name, page_size, max_pages, runs), path, as_of)


def database_snapshot(
    source: DataFrame, folder: str, as_of: datetime | None = None, keep: int | None = MAX_SNAPSHOTS
) -> tuple[str | None, DataFrame | None]:
    """Copy a database table to `latest` and `history`; label and summary of what was written. Of the history the
    newest `keep` snapshots stay, the others are deleted; None keeps all. The source is read once, for the rows
    and the summary."""
    written = observed_snapshot(source, folder, as_of, summary_measures(source.columns), keep)
    if written is None:
        return None, None
    label, found = written
    return label, observed_summary(source.sparkSession, found, source.columns)


def retained_history(spark: SparkSession, folder: str, keep: int = MAX_SNAPSHOTS) -> DataFrame:
    """The newest snapshots of a database table."""
    return newest_snapshots(history(spark, folder), keep=keep)
