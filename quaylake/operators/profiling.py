"""Profile of a table: nulls, distinct values, numeric description, schema."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.functions.casting import quoted

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

# A range of values is cut into this many slices of equal width.
SLICES = 1000

# The values of a range with so few rows are slices of their own.
SETTLED = 10_000

# Size of the quantile sketches (some 50 KB), and the margin of ranks taken on both sides of a quartile: more than
# three times the error that such a sketch states.
SKETCH_SIZE = 2048
MARGIN = 0.005


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def schema_listing(df: DataFrame) -> DataFrame:
    """Column name and type, one row per column."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one row each, from a single scan."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    return long_rows(
        counted, [[F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")] for i, c in enumerate(names)]
    )


def long_rows(one_row: DataFrame, rows: Sequence[Sequence[Column]]) -> DataFrame:
    """One row of many columns to many rows of few."""
    return one_row.select(F.inline(F.array(*[F.struct(*r) for r in rows])))


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, column names, nulls by column."""
    return summary_of(df.agg(*summary_measures(df.columns)), df.columns)


def summary_measures(names: Sequence[str]) -> list[Column]:
    """What a summary counts, as aggregates: by a scan, or by `DataFrame.observe` while the rows are written."""
    nulls = [F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)]
    return [F.count(F.lit(1)).alias("total_rows"), *nulls]


def observed_summary(spark: SparkSession, found: Mapping[str, int], names: Sequence[str]) -> DataFrame:
    """The summary from measures that were taken while the rows were written."""
    values = {"total_rows": found["total_rows"], **{f"n{i}": found[f"n{i}"] for i in range(len(names))}}
    schema = ", ".join(f"{name} bigint" for name in values)
    return summary_of(spark.createDataFrame([tuple(values.values())], schema), names)


def summary_of(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    pairs = [v for i, c in enumerate(names) for v in (F.lit(c), F.col(f"n{i}"))]
    return counted.select(
        "total_rows",
        F.lit(len(names)).alias("total_columns"),
        F.array(*[F.lit(c) for c in names]).alias("columns"),
        F.create_map(*pairs).alias("null_counts"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None, list_up_to: int = 10) -> DataFrame:
    """Distinct non-null values per text column, with the sorted list where there are few.

    One scan and one deduplication: each value is a (column, 128-bit hash) key, so that texts are no
    shuffle keys and no task holds the set of a column. The texts of columns with few values are read
    by one more scan. Both run here; the driver gets a count per column and the few values.
    """
    names = list(columns or text_columns(df))
    pairs = hashed_values(df, names).select("i", "hash").distinct()
    counts = pairs.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    found = {r["i"]: r["n"] for r in counts.collect()}  # one row per column
    few = [i for i, n in found.items() if n <= list_up_to]
    listed: dict[int, list[str]] = {}
    if few:
        # At most `list_up_to` values per column: the groups are bounded.
        for r in hashed_values(df, [names[i] for i in few]).groupBy("i", "hash").agg(F.min("value").alias("value")).collect():
            listed.setdefault(few[r["i"]], []).append(r["value"])
    rows = [(name, found.get(i, 0), sorted(listed[i]) if i in listed else None) for i, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "column string, distinct_values bigint, values array<string>")


def hashed_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column and non-null value: number of the column, hash, value."""
    def entry(i: int, name: str) -> Column:
        value = quoted(name)
        hashed = F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))
        return F.struct(F.lit(i).alias("i"), hashed.alias("hash"), value.alias("value"))

    entries = F.array(*[entry(i, c) for i, c in enumerate(names)])
    return df.select(F.inline(entries)).filter(F.col("value").isNotNull())


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles (interpolated) and max per column.

    Nulls and NaN are left out. No column is sorted or gathered for the quartiles. The first scan also takes a
    quantile sketch of each column; its values on both sides of a quartile are a bracket that almost surely holds
    it. The second cuts the brackets into slices of equal width and counts them and what lies beside them, so
    that a bracket that misses is noticed and the search goes on where the rank is. The third settles slices of
    at most SETTLED rows by their values: three scans for all columns together up to a thousand million even rows.
    Larger or odd slices are cut on, first by powers of two if they are wide: nine scans at most, whatever the
    values. They run here; the driver gets the measures and, per wanted rank, one slice.
    """
    names = list(columns or numeric_columns(df))
    numbers = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(names)])
    sketched = [F.kll_sketch_agg_double(F.col(f"c{i}"), F.lit(SKETCH_SIZE)).alias(f"sketch{i}") for i in range(len(names))]
    measured = numbers.agg(*plain_measures(len(names)), *sketched)
    plain = [c for c in measured.columns if not c.startswith("sketch")]
    summary = measured.select(*plain, *[bracket_ends(i) for i in range(len(names))]).first()
    wanted = [r for i in range(len(names)) if (r := whole_range(summary, i)) is not None]
    values = values_at_ranks(numbers, wanted)
    rows = []
    for i, name in enumerate(names):
        count, mean, std, low, high = [summary[f"{m}{i}"] for m in MEASURE_NAMES]
        quartiles = [quartile(values, i, count, share) for share in QUARTILES.values()]
        rows.append((name, count, mean, std, low, *quartiles, high))
    types = ", ".join(f"{n} double" for n in ("mean", "std", "min", *QUARTILES, "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count bigint, {types}")


def number(column: str) -> Column:
    value = quoted(column).cast("double")
    return F.when(~F.isnan(value), value)


MEASURE_NAMES = ("count", "mean", "std", "min", "max")


def plain_measures(width: int) -> list[Column]:
    functions = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    return [
        measure(F.col(f"c{i}")).alias(f"{name}{i}")
        for i in range(width)
        for name, measure in zip(MEASURE_NAMES, functions)
    ]


def bracket_ends(i: int) -> Column:
    """By the sketch of column i, the values below and above each quartile."""
    ranks = F.array(*[F.lit(share + side) for share in QUARTILES.values() for side in (-MARGIN, MARGIN)])
    ends = F.kll_sketch_get_quantile_double(F.col(f"sketch{i}"), ranks)
    return F.when(F.col(f"count{i}") > 0, ends).alias(f"ends{i}")


def disjoint(ends: Sequence[float]) -> tuple[tuple[float, float], ...]:
    """Brackets in rising order; those that meet are one."""
    out: list[tuple[float, float]] = []
    for low, high in zip(ends[::2], ends[1::2]):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return tuple(out)


def cut(value: Column, low: float, high: float) -> Column:
    """Slices of equal width. Both ends are slices of their own, so every cut leaves something out. Halves
    keep the width of a very wide range finite."""
    width = high / 2 - low / 2
    inner = F.lit(1).cast("bigint")
    if 0 < width < math.inf:
        inner = F.floor((value / 2 - F.lit(low / 2)) / F.lit(width) * SLICES) + 1
    return F.when(value == low, F.lit(0)).when(value == high, F.lit(SLICES + 2)).otherwise(inner)


@dataclass(frozen=True)
class RankRange:
    """A range of column i that holds the wanted ranks: its ends, rows below and in it, and the brackets in which
    a whole column is looked at."""

    i: int
    low: float
    high: float
    below: int
    rows: int
    ranks: tuple[int, ...]
    brackets: tuple[tuple[float, float], ...] = ()

    def column(self) -> Column:
        return F.col(f"c{self.i}")

    def holds(self) -> Column:
        return self.column().between(self.low, self.high)

    def slice(self) -> Column:
        """Number of the slice the value falls in, rising with the value."""
        if self.rows <= SETTLED:
            return self.column()
        if self.brackets:
            return self.zone().cast("double")
        return (self.power() if self.wide() else cut(self.column(), self.low, self.high)).cast("double")

    def zone(self) -> Column:
        """Brackets are cut; what lies beside them is one slice each."""
        step, value = SLICES + 5, self.column()
        out = F.lit(2 * len(self.brackets) * step)
        for k in reversed(range(len(self.brackets))):
            low, high = self.brackets[k]
            inside = cut(value, low, high) + (2 * k + 1) * step
            out = F.when(value < low, F.lit(2 * k * step)).when(value <= high, inside).otherwise(out)
        return out

    def wide(self) -> bool:
        """Its ends differ in sign or are so far apart that slices of equal width could leave all values in one."""
        small, large = sorted((abs(self.low), abs(self.high)))
        return self.low < 0 < self.high or large > max(SLICES, 4) * small

    def power(self) -> Column:
        """By sign and power of two; infinite values and zero are slices of their own."""
        value, size = self.column(), F.abs(self.column())
        inner = F.floor(F.log2(F.when((size > 0) & (size < math.inf), size).otherwise(1.0))) + 2000
        inner = F.when(size == math.inf, 9000).when(size == 0, 0).otherwise(inner)
        return F.when(value < 0, -inner).otherwise(inner).cast("bigint")


def ranks_of(count: int) -> tuple[int, ...]:
    """Ranks on both sides of each quartile, from 0."""
    places = [(count - 1) * share for share in QUARTILES.values()]
    return tuple(sorted({math.floor(p) for p in places} | {math.ceil(p) for p in places}))


def whole_range(summary: Row, i: int) -> RankRange | None:
    count = summary[f"count{i}"]
    if count == 0:
        return None
    return RankRange(i, summary[f"min{i}"], summary[f"max{i}"], 0, count, ranks_of(count), disjoint(summary[f"ends{i}"]))


def values_at_ranks(numbers: DataFrame, ranges: Sequence[RankRange]) -> dict[tuple[int, int], float]:
    """The value at each wanted rank, by column and rank."""
    values = {}
    while ranges:
        values |= {(r.i, rank): r.low for r in ranges if r.low == r.high for rank in r.ranks}
        ranges = narrowed(numbers, [r for r in ranges if r.low < r.high])
    return values


def narrowed(numbers: DataFrame, ranges: Sequence[RankRange]) -> list[RankRange]:
    """Per range the slices that hold its ranks, between their least and largest value; one scan."""
    if not ranges:
        return []
    inside = F.array(*[
        F.when(r.holds(), F.struct(F.lit(k).alias("k"), r.slice().alias("slice"), r.column().alias("value")))
        for k, r in enumerate(ranges)
    ])
    counted = (
        numbers.select(F.inline(inside))
        .filter(F.col("k").isNotNull())
        .groupBy("k", "slice")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # At most SETTLED slices per range; only those with a wanted rank go on.
    below = F.array(*[F.lit(r.below).cast("bigint") for r in ranges])
    ranks = F.array(*[F.array(*[F.lit(n).cast("bigint") for n in r.ranks]) for r in ranges])
    until = F.get(below, F.col("k")) + F.sum("rows").over(Window.partitionBy("k").orderBy("slice"))
    here = F.filter(F.get(ranks, F.col("k")), lambda n: (n >= F.col("until") - F.col("rows")) & (n < F.col("until")))
    found = counted.withColumn("until", until).withColumn("ranks", here).where(F.size("ranks") > 0)
    return [
        RankRange(ranges[r["k"]].i, r["low"], r["high"], r["until"] - r["rows"], r["rows"], tuple(r["ranks"]))
        for r in found.orderBy("k", "slice").collect()  # at most one row per wanted rank
    ]


def quartile(values: dict[tuple[int, int], float], i: int, count: int, share: float) -> float | None:
    """Linear interpolation between the two neighbouring ranks."""
    if count == 0:
        return None
    place = (count - 1) * share
    low, high = values[i, math.floor(place)], values[i, math.ceil(place)]
    return low if low == high else low + (high - low) * (place - math.floor(place))
