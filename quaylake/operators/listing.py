"""Report over the text listing of a database dump, one object per line."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.functions.text import token_from_end
from quaylake.session import broadcast_if_small, materialize


@dataclass(frozen=True)
class LineKind:
    """Lines that contain all of `having` and none of `without`."""

    having: tuple[str, ...]
    without: tuple[str, ...] = ()

    def test(self, line: Column) -> Column:
        tests = [line.contains(text) for text in self.having]
        tests += [~line.contains(text) for text in self.without]
        return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class Mention:
    """A line of `kind` names an object when it contains the name followed by `suffix`."""

    kind: LineKind
    suffix: str = ""


# How a listing marks its objects. A foreign key counts as a constraint too.
OBJECT_KINDS = {
    "tables": LineKind(("TABLE", "public"), ("TABLE DATA",)),
    "indexes": LineKind(("INDEX",)),
    "constraints": LineKind(("CONSTRAINT",)),
    "foreign_keys": LineKind(("FK CONSTRAINT",)),
}
TABLE_LINE = LineKind(("TABLE public ",), ("TABLE DATA",))
MENTIONS = {
    "indexes": Mention(LineKind(("INDEX",)), "_"),
    "foreign_keys": Mention(LineKind(("FK CONSTRAINT",))),
}
HEADER_MARK = ";"
NAME_FROM_END = 2
NAME_MIN_TOKENS = 4


def kind_counts(lines: DataFrame, kinds: dict[str, LineKind] = OBJECT_KINDS) -> DataFrame:
    """Number of lines of each kind, in one row; a line may be of several kinds."""
    return lines.agg(*[F.count_if(k.test(F.col("value"))).alias(name) for name, k in kinds.items()])


def header(lines: DataFrame, order: str) -> DataFrame:
    """All comment lines of the listing, in the order that `order` gives the lines."""
    return lines.filter(F.col("value").startswith(HEADER_MARK)).orderBy(F.asc(order))


def object_names(
    lines: DataFrame, kind: LineKind = TABLE_LINE,
    from_end: int = NAME_FROM_END, at_least: int = NAME_MIN_TOKENS,
) -> DataFrame:
    """Distinct object names: a token counted from the end of the lines of one kind."""
    name = token_from_end(F.col("value"), from_end, at_least)
    found = lines.filter(kind.test(F.col("value"))).select(name.alias("name"))
    return found.filter(F.col("name").isNotNull()).distinct()


# Lengths of the pieces that names are looked up by: a name has the longest one that fits.
GRAM_SIZES = (1, 2, 4, 8, 16)


def mention_counts(
    lines: DataFrame, names: DataFrame, mentions: dict[str, Mention] = MENTIONS,
) -> DataFrame:
    """Per name the number of lines that mention it, one column per mention rule.

    `names` holds distinct names. Lines and names meet by rare pieces (`met`), and each pair is compared once
    more at its place; lines are never compared with all names, and of a line no more moves than its number and
    the hashes of its pieces until a name is met. A piece that occurs very often is split by adaptive execution.
    A line counts once per name. Finding the names, numbering the lines and counting pieces runs jobs.
    """
    names = materialize(names.select("name").where(F.length("name") > 0))
    kinds = {f"is_{column}": m.kind.test(F.col("value")) for column, m in mentions.items()}
    relevant = lines.select("value", *[test.alias(name) for name, test in kinds.items()])
    relevant = relevant.where(reduce(lambda a, b: a | b, [F.col(name) for name in kinds]))
    numbered = materialize(relevant.withColumn("line", F.monotonically_increasing_id()))
    pairs = met(numbered, names).join(numbered, "line")

    def there(suffix: str) -> Column:
        wanted = F.concat("name", F.lit(suffix))
        return F.substring(F.col("value"), F.col("start"), F.length(wanted)) == wanted

    hit = [
        (F.col(f"is_{column}") & there(m.suffix)).cast("int").alias(column) for column, m in mentions.items()
    ]
    once = pairs.where(there("")).select("name", "line", *hit).groupBy("name", "line")
    counted = once.agg(*[F.max(c).alias(c) for c in mentions]).groupBy("name")
    counted = counted.agg(*[F.sum(column).alias(column) for column in mentions])
    return names.join(counted, "name", "left").select(
        "name", *[F.coalesce(F.col(column), F.lit(0)).alias(column) for column in mentions]
    )


def met(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs (`line`, `name`, `start`) that can be mentions: all true ones, and few others.

    Every name is looked up by one of its pieces of a fixed length: the one that occurs least often in the
    lines, which one aggregation counts. Lines are cut into pieces once. So names with one beginning, or a very short name among long ones,
    don't make lines and names meet that have nothing else in common.
    """
    sized = names.withColumn("size", F.lit(GRAM_SIZES[0]))
    for size in GRAM_SIZES[1:]:
        sized = sized.withColumn("size", F.when(F.length("name") >= size, F.lit(size)).otherwise(F.col("size")))
    used = sorted(r["size"] for r in sized.select("size").distinct().collect())  # at most as many as GRAM_SIZES
    at = F.explode(F.sequence(F.lit(1), F.length("name") - F.col("size") + 1)).alias("at")
    pieces = sized.select("name", "size", at)
    pieces = pieces.select("name", "size", "at", F.xxhash64(F.substring(F.col("name"), F.col("at"), F.col("size"))).alias("key"))
    known = broadcast_if_small(materialize(pieces.select("key").distinct()))
    hits = materialize(grams(lines, used).join(known, "key", "left_semi"))
    # A name with a piece that no line has is mentioned nowhere.
    rare = pieces.join(hits.groupBy("key").count(), "key").groupBy("name", "size").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("count", "at", "key")).alias("seed")
    )
    seeds = rare.where(F.col("found") == F.length("name") - F.col("size") + 1).select("name", "seed.at", "seed.key")
    start = (F.col("place") - F.col("at") + 1).alias("start")
    return hits.join(seeds, "key").select("line", "name", start).where("start >= 1")


def grams(lines: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(`line`, `place`, `key`): the hash of every piece of the given lengths, of every line."""
    placed = lines.where(F.length("value") > 0).select(
        "line", "value", F.explode(F.sequence(F.lit(1), F.length("value"))).alias("place")
    )
    fits = F.filter(F.lit(list(sizes)), lambda size: F.col("place") + size - 1 <= F.length("value"))
    each = placed.select("line", "place", "value", F.explode(fits).alias("size"))
    return each.select("line", "place", F.xxhash64(F.substring(F.col("value"), F.col("place"), F.col("size"))).alias("key"))
