"""Reports over the reconciliation table and over dump listings; each part is a lazy frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.functions.casting import quoted
from quaylake.operators.grouping import (
    daily_series, match_summary, measure_by, open_totals, totals, value_counts, within,
)
from quaylake.operators.listing import header, kind_counts, mention_counts, object_names
from quaylake.operators.profiling import (
    dataset_summary, describe, distinct_values, null_counts, schema_listing,
)
from quaylake.operators.ranking import first_rows, sorted_by_amount, top_groups, top_rows

# Sizes of the rankings, the studied range and the threshold of large amounts.
TOP_SUPPLIERS = 10
TOP_SUPPLIERS_IN_RANGE = 5
TOP_LARGE = 5
TOP_IN_RANGE = 20
TOP_IN_SLICE = 5
RANGE = (1000, 5000)
LARGE = 10000
HEAD = 5


@dataclass(frozen=True)
class Columns:
    """Column names of a reconciliation table; another table may be studied under its own."""

    id: str = "id"
    run: str = "run_id"
    status: str = "status"
    source: str = "source"
    supplier: str = "supplier"
    amount: str = "amount"
    created: str = "created_at"
    reason: str = "match_reason"
    score: str = "match_score"
    matched: str = "MATCHED"
    unmatched: str = "UNMATCHED"
    also_unmatched: tuple[str, ...] = ("UNMATCHED_MOVEMENT",)


DEFAULT = Columns()


@dataclass(frozen=True)
class Report:
    """A table under study. Every method that yields a frame is one part of the report."""

    df: DataFrame
    columns: Columns = DEFAULT

    def present(self, *names: str) -> list[str]:
        return [n for n in names if n in self.df.columns]


class ConsoleReport(Report):
    """Row count, schema, status counts and values, top suppliers."""

    def total(self) -> DataFrame:
        return self.df.agg(F.count(F.lit(1)).alias("total"))

    def schema(self) -> DataFrame:
        return schema_listing(self.df)

    def status(self) -> DataFrame:
        return measure_by(self.df, self.columns.status, None, {"count": "rows"}, "count")

    def status_value(self) -> DataFrame:
        c = self.columns
        return measure_by(self.df, c.status, c.amount, {"total": "sum", "media": "mean"}, "total")

    def top_suppliers(self) -> DataFrame:
        c = self.columns
        return top_groups(self.df, c.supplier, c.amount, {"count": "rows", "total": "sum"}, "count", TOP_SUPPLIERS)


class Dashboard(Report):
    """The numbers behind the charts."""

    def status(self) -> DataFrame:
        return measure_by(self.df, self.columns.status, None, {"count": "rows"}, "count")

    def status_value(self) -> DataFrame:
        return measure_by(self.df, self.columns.status, self.columns.amount, {"total": "sum"}, "total")

    def top_suppliers(self) -> DataFrame:
        c = self.columns
        return top_groups(self.df, c.supplier, c.amount, {"count": "rows", "total": "sum"}, "total", TOP_SUPPLIERS)

    def daily(self) -> DataFrame:
        return daily_series(self.df, self.columns.created, self.columns.amount)

    def summary(self) -> DataFrame:
        return match_summary(self.df, self.columns.status, self.columns.amount, self.columns.matched)


@dataclass(frozen=True)
class RangeStudy(Report):
    """Large amounts, and the rows within a range."""

    low: float = RANGE[0]
    high: float = RANGE[1]
    threshold: float = LARGE

    def part(self) -> DataFrame:
        return within(self.df, self.columns.amount, self.low, self.high)

    def large(self) -> DataFrame:
        c = self.columns
        above = self.df.filter(quoted(c.amount) > self.threshold)
        shown = [quoted(n) for n in (c.id, c.status, c.amount, c.supplier)]
        return top_rows(above, c.amount, TOP_LARGE, [c.id]).select(*shown)

    def rows(self) -> DataFrame:
        c = self.columns
        shown = [quoted(n) for n in (c.id, c.status, c.source, c.amount, c.supplier, c.created)]
        return top_rows(self.part(), c.amount, TOP_IN_RANGE, [c.id]).select(*shown)

    def totals(self) -> DataFrame:
        return totals(self.part(), self.columns.amount, {"quantidade": "rows", "total": "sum", "media": "mean"})

    def status(self) -> DataFrame:
        c = self.columns
        return measure_by(self.part(), c.status, c.amount, {"qtd": "rows", "total": "sum"}, "qtd")

    def top_suppliers(self) -> DataFrame:
        c = self.columns
        wanted = {"qtd": "rows", "total": "sum"}
        return top_groups(self.part(), c.supplier, c.amount, wanted, "qtd", TOP_SUPPLIERS_IN_RANGE)

    def slice(self) -> DataFrame:
        """The whole range, largest amounts first, as it is exported."""
        return sorted_by_amount(self.part(), self.columns.amount, [self.columns.id])

    def statistics(self) -> DataFrame:
        """Numeric description of amount and score; runs jobs."""
        return describe(self.part(), self.present(self.columns.amount, self.columns.score))


@dataclass(frozen=True)
class SliceReport(Report):
    """Groups of an exported slice that was read again. `order` stands for the order of its
    lines: among equal amounts the earlier row is the larger."""

    order: tuple[str, ...] = ("id",)

    def status(self) -> DataFrame:
        c = self.columns
        wanted = {"count": "count", "sum": "sum", "mean": "mean"}
        return measure_by(self.df, c.status, c.amount, wanted, null_keys=False)

    def source(self) -> DataFrame:
        c = self.columns
        return measure_by(self.df, c.source, c.amount, {"count": "count", "sum": "sum"}, null_keys=False)

    def largest(self) -> DataFrame:
        c = self.columns
        shown = self.present(c.status, c.amount, c.supplier, c.reason)
        return top_rows(self.df, c.amount, TOP_IN_SLICE, self.order).select(*[quoted(n) for n in shown])

    def unmatched(self) -> DataFrame:
        c = self.columns
        return open_totals(self.df, c.status, c.amount, c.unmatched, c.also_unmatched)


class Profile(Report):
    """Shape, nulls, distinct values, frequencies, measures by status, the headline numbers."""

    def summary(self) -> DataFrame:
        return dataset_summary(self.df)

    def schema(self) -> DataFrame:
        return schema_listing(self.df)

    def head(self) -> DataFrame:
        return first_rows(self.df, HEAD, [self.columns.id])

    def nulls(self) -> DataFrame:
        return null_counts(self.df)

    def statistics(self) -> DataFrame:
        """Numeric description of all numeric columns; runs jobs."""
        return describe(self.df)

    def distinct(self) -> DataFrame:
        return distinct_values(self.df)

    def counts(self, column: str) -> DataFrame:
        """Frequency of each value; studied for status, source, reason and run."""
        return value_counts(self.df, column)

    def top_suppliers(self) -> DataFrame:
        return value_counts(self.df, self.columns.supplier).limit(TOP_SUPPLIERS)

    def by_status(self) -> DataFrame:
        c = self.columns
        wanted = {"count": "count", "sum": "sum", "mean": "mean", "min": "min", "max": "max"}
        return measure_by(self.df, c.status, c.amount, wanted, null_keys=False)

    def headline(self) -> DataFrame:
        return match_summary(self.df, self.columns.status, self.columns.amount, self.columns.matched)

    def unmatched(self) -> DataFrame:
        c = self.columns
        return open_totals(self.df, c.status, c.amount, c.unmatched, c.also_unmatched)


@dataclass(frozen=True)
class DumpReport:
    """Objects of a dump listing; `order`, a column that numbers the lines, is for the header."""

    lines: DataFrame
    order: str = "n"

    def header(self) -> DataFrame:
        return header(self.lines, self.order)

    def objects(self) -> DataFrame:
        return kind_counts(self.lines)

    def tables(self) -> DataFrame:
        return object_names(self.lines).orderBy("name")

    def mentions(self) -> DataFrame:
        """Indexes and foreign keys that mention each table; runs jobs."""
        return mention_counts(self.lines, object_names(self.lines)).orderBy("name")
