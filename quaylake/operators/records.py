"""Landed JSON pages to records.

A landed page is one row (page number, HTTP status, payload text), optionally
with the columns that tell one read of an endpoint from another. Records stay
`VARIANT` until their fields are chosen, so a payload is parsed once per pass.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions.casting import literal_name, quoted
from quaylake.session import BROADCAST_BYTES, broadcast_if_small, materialize

# Envelope members that may hold the records, in order of preference.
ENVELOPE_KEYS = ("content", "data", "results", "rows", "items")
LENIENT_ENVELOPE_KEYS = ("content", "data", "results")

# Fixed value: records on a full page of the API.
PAGE_SIZE = 500

STRICT = "strict"
LENIENT = "lenient"


def member_path(name: str) -> str:
    return f"$['{name}']"


def as_list(value: Column, path: str = "$") -> Column:
    """Elements of a JSON array, null for anything else."""
    return F.try_variant_get(value, path, "array<variant>")


def is_object(value: Column) -> Column:
    """Only a JSON object casts to a struct; its fields are not looked at."""
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def with_records(pages: DataFrame, mode: str = STRICT, payload: str = "payload") -> DataFrame:
    """Replace the payload text by `records` (array of objects) and `unreadable` (not JSON).

    strict: an array payload, else the first envelope member that is a list, else the first
    member in document order that is a list of objects only; elements other than objects go.
    lenient: an array payload, else the first envelope member that is a non-empty list.
    """
    document = F.col("_document")
    if mode == LENIENT:
        lists = [as_list(document), *[as_list(document, member_path(k)) for k in LENIENT_ENVELOPE_KEYS]]
        found = [F.when(F.size(a) > 0, F.filter(a, is_object)) for a in lists]
    else:
        # A map keeps the members in document order; a variant would sort them.
        members = F.map_values(F.from_json(quoted(payload), "map<string,variant>"))
        lists = F.transform(members, lambda m: as_list(m))
        only_objects = F.filter(lists, lambda a: a.isNotNull() & F.forall(a, is_object))
        envelope = [as_list(document, member_path(k)) for k in ENVELOPE_KEYS]
        found = [
            F.filter(F.coalesce(as_list(document), *envelope, F.get(only_objects, F.lit(0))), is_object)
        ]
    nothing = F.array().cast("array<variant>")
    return (
        pages.withColumn("_document", F.try_parse_json(quoted(payload)))
        .withColumn("records", F.coalesce(*found, nothing))
        .withColumn("unreadable", document.isNull())
        .drop("_document", payload)
    )


def page_records(
    pages: DataFrame, mode: str = STRICT, payload: str = "payload", skip_unreadable: bool = False
) -> DataFrame:
    """One row per record of every page, without any paging rule.

    A payload that is not JSON fails the job; `skip_unreadable` leaves such pages out instead.
    Outer explode and a filter on its output: a plain explode makes the optimizer test the list
    below the projection, which would parse every payload a second time.
    """
    listed = F.col("records")
    if not skip_unreadable:
        failed = F.raise_error(F.lit("a payload is not JSON")).cast("array<variant>")
        listed = F.when(F.col("unreadable"), failed).otherwise(listed)
    return (
        with_records(pages, mode, payload)
        .withColumn("record", F.explode_outer(listed))
        .filter(F.col("record").isNotNull())
        .drop("records", "unreadable")
    )


def page_states(pages: DataFrame, page_size: int, runs: Sequence[str], mode: str) -> DataFrame:
    """One row per run and page number, kept in the shared folder: how often the page was landed,
    and whether it is short, refused or broken. Payloads are parsed here once for all bounds."""
    answered = F.col("status").eqNullSafe(200)
    sized = with_records(pages, mode)
    states = sized.groupBy(*[quoted(r) for r in runs], "page").agg(
        F.count(F.lit(1)).alias("times"),
        F.max(answered & ~F.col("unreadable") & (F.size("records") < page_size)).alias("short"),
        F.max(~answered).alias("refused"),
        F.max(answered & F.col("unreadable")).alias("broken"),
    )
    return materialize(states)


def same_run(runs: Sequence[str]) -> Column:
    """Null-safe, so that pages without a run name make up a run of their own."""
    pairs = [quoted(r).eqNullSafe(quoted(f"_bound_{r}")) for r in runs]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def last_pages(
    pages: DataFrame,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    runs: Sequence[str] = (),
    mode: str = STRICT,
    whole: bool = True,
) -> DataFrame:
    """Last page a reader would have kept, one row per run (null: all of them).

    Reading ends with the first page that holds fewer than `page_size` records. A page that
    is asked for and has another status than 200 fails the read (strict) or ends it with the
    page before (lenient); one that is not JSON fails it in both modes.

    Up to its end a read must be whole, or it fails: no page number is null or below 1, missing or
    landed twice, and a limit of `max_pages` is not reached with a full page. `whole=False` takes
    what is there. Runs one job over the payloads; the rest works on one row per page.
    """
    states = page_states(pages, page_size, runs, mode)
    names = [quoted(r) for r in runs]
    asked = F.col("page") >= 1
    if max_pages is not None:
        asked = asked & (F.col("page") <= max_pages)
    ends = states.groupBy(*names).agg(
        F.min(F.when(asked & F.col("short"), F.col("page"))).alias("short"),
        F.min(F.when(asked & F.col("refused"), F.col("page"))).alias("refused"),
        F.min(F.when(asked & F.col("broken"), F.col("page"))).alias("broken"),
        F.count_if(F.col("page").isNull() | (F.col("page") < 1)).alias("unnumbered"),
    )
    end, fatal = F.col("short"), F.col("broken")
    if mode == LENIENT:
        end = F.least(end, F.col("refused") - 1)
    else:
        fatal = F.least(fatal, F.col("refused"))
    # A fatal page counts only when the reader would have come to it.
    reached = fatal.isNotNull() & (end.isNull() | (fatal <= end))
    ends = ends.select(*names, end.cast("int").alias("end"), F.when(reached, fatal).alias("fatal"), "unnumbered")
    bounds = ends.withColumnsRenamed({r: f"_bound_{r}" for r in runs})
    inside = states.join(bounds, same_run(runs)).where(asked & (F.col("page") <= F.coalesce("end", "page")))
    found = inside.groupBy(*[quoted(f"_bound_{r}") for r in runs]).agg(
        F.count(F.lit(1)).alias("pages"), F.max("page").alias("highest"), F.max("times").alias("times")
    ).withColumnsRenamed({f"_bound_{r}": f"_found_{r}" for r in runs})
    met = reduce(lambda a, b: a & b, [quoted(r).eqNullSafe(quoted(f"_found_{r}")) for r in runs], F.lit(True))
    checked = ends.join(found, met, "left")
    problems = F.when(F.col("fatal").isNotNull(), F.concat(F.lit("page "), F.col("fatal"), F.lit(" could not be read")))
    if whole:
        problems = problems.when(F.col("unnumbered") > 0, F.lit("a page has no number from 1 on"))
        problems = problems.when(F.col("times") > 1, F.lit("a page was landed more than once"))
        expected = F.coalesce("end", "highest")
        problems = problems.when(F.col("pages") < expected, F.concat(
            F.lit("pages are missing: "), F.col("pages"), F.lit(" of "), expected
        ))
        if max_pages is not None:
            full = F.col("end").isNull() & (F.col("highest") >= max_pages)
            problems = problems.when(full, F.lit(f"the limit of {max_pages} pages was reached with a full page"))
    last = F.when(problems.isNotNull(), F.raise_error(problems).cast("int")).otherwise(F.col("end"))
    return checked.select(*names, last.alias("last_page"))


def numbered_pages(pages: DataFrame, max_pages: int | None) -> DataFrame:
    numbered = pages.filter(F.col("page") >= 1)
    return numbered if max_pages is None else numbered.filter(F.col("page") <= max_pages)


def kept_pages(
    pages: DataFrame,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    runs: Sequence[str] = (),
    mode: str = STRICT,
    whole: bool = True,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The pages a sequential reader would have kept (see `last_pages`).

    The bounds are found by a job that runs here, so that they are not searched again by every
    later use of the records, and payloads are not shuffled: a single bound goes to the scan as
    a plain filter. With `runs` the bounds are kept in the shared folder, measured, and broadcast
    if small; beyond that limit they are joined by a shuffle that adaptive execution splits where
    a run is hot.
    """
    numbered = numbered_pages(pages, max_pages)
    bounds = last_pages(pages, page_size, max_pages, runs, mode, whole)
    if not runs:
        last = bounds.first()["last_page"]  # one row
        kept = numbered if last is None else numbered.filter(F.col("page") <= last)
    else:
        bounds = materialize(bounds).withColumnsRenamed({r: f"_bound_{r}" for r in runs})
        joined = numbered.join(broadcast_if_small(bounds, broadcast_limit), same_run(runs))
        kept = joined.filter(F.col("page") <= F.coalesce(F.col("last_page"), F.col("page")))
    return kept.select(*[literal_name(c) for c in pages.columns])


def page_sequence(
    pages: DataFrame,
    page_size: int = PAGE_SIZE,
    max_pages: int | None = None,
    runs: Sequence[str] = (),
    mode: str = STRICT,
    whole: bool = True,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Records of the pages a sequential reader would have kept: runs, page, record."""
    kept = kept_pages(pages, page_size, max_pages, runs, mode, whole, broadcast_limit)
    return page_records(kept, mode).select(*[literal_name(r) for r in runs], "page", "record")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unwrap_row(records: DataFrame, strict: bool = False) -> DataFrame:
    """Replace a record by its `row` member.

    Without an object there the record itself stays; strict makes it null instead (the row is
    kept and all its fields become null).
    """
    row = F.col("_row")
    fallback = F.lit(None).cast("variant") if strict else F.col("record")
    return (
        records.withColumn("_row", F.try_variant_get("record", member_path("row"), "variant"))
        .withColumn("record", F.when(is_object(row), row).otherwise(fallback))
        .drop("_row")
    )


def quoted_type(kind: T.DataType) -> str:
    """Type text with every name quoted, so that any key can be read back."""
    if isinstance(kind, T.StructType):
        return struct_type({f.name: quoted_type(f.dataType) for f in kind.fields})
    if isinstance(kind, T.ArrayType):
        return f"array<{quoted_type(kind.elementType)}>"
    return kind.simpleString()


def struct_type(fields: Mapping[str, str]) -> str:
    return "struct<" + ",".join(f"{literal_name(name)}:{kind}" for name, kind in fields.items()) + ">"


def select_fields(records: DataFrame, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Fields of a record as columns, in order, all in one pass over the record.

    A missing field, a field of another kind, or a scalar where a record is expected is null.
    """
    kept = [literal_name(k) for k in keep]
    read = F.try_variant_get("record", "$", struct_type(fields)).alias("_fields")
    return records.select(*kept, read).select(*kept, "_fields.*")


def inferred_schema(records: DataFrame) -> T.StructType:
    """All keys seen in the records, each with a type that holds every value.

    Runs one aggregation; only the schema text comes back. Numbers with a fraction are read as
    double, keys that are always null as string; values of unlike kinds stay `VARIANT`.
    """
    text = records.agg(F.schema_of_variant_agg("record").alias("schema")).first()["schema"]
    if text is None or not text.startswith("OBJECT<"):
        return T.StructType()
    return VariantSchema(text).kind()


class VariantSchema:
    """Reads the text of a variant's schema; names are as in SQL, quoted where they need it."""

    PLAIN = {
        "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "DOUBLE": T.DoubleType(),
        "FLOAT": T.DoubleType(), "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(),
        "TIMESTAMP_NTZ": T.TimestampNTZType(), "VOID": T.StringType(), "DECIMAL": T.DoubleType(),
        "BINARY": T.BinaryType(),
    }

    def __init__(self, text: str) -> None:
        self.tokens = re.findall(r"`(?:[^`]|``)*`|[<>:,]|\(\d+,\s*\d+\)|[^\s<>:,`()]+", text)
        self.at = 0

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def kind(self) -> T.DataType:
        name = self.take()
        if name == "ARRAY":
            self.take()
            element = self.kind()
            self.take()
            return T.ArrayType(element)
        if name == "OBJECT":
            fields, mark = [], self.take()
            while mark in "<,":
                if self.tokens[self.at] == ">":  # an object without keys
                    mark = self.take()
                    continue
                key = self.take()
                self.take()
                fields.append(T.StructField(key[1:-1].replace("``", "`") if key[0] == "`" else key, self.kind()))
                mark = self.take()
            return T.StructType(fields)
        if name == "DECIMAL":
            self.take()
        return self.PLAIN.get(name, T.VariantType())


def field_types(schema: T.StructType) -> dict[str, str]:
    return {field.name: quoted_type(field.dataType) for field in schema.fields}
