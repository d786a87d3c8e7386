"""Removal of boilerplate: lines that spread over many sites."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import numbered, position, saved, text_hash

SITES = 6
MIN_CHARS = 1  # after trimming, so only empty lines don't count
LG_K = 12
# The sketch's relative standard error, and how many of them are near.
ERROR, NEAR = 1.04 / math.sqrt(2**LG_K), 6.0


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def lines_of(docs: DataFrame, id: str, site: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that is long enough: document, hash of the site, place, hash of the line.
    Null sites count as one."""
    rows = numbered(docs).select(
        document(docs, id, text).alias("key"),
        F.xxhash64(F.coalesce(F.col(f"c{position(docs, site)}").cast("string"), F.lit("\0"))).alias("site"),
        F.posexplode(F.split(F.col(f"c{position(docs, text)}"), "\n", -1)).alias("at", "line"),
    )
    rows = rows.withColumn("line", trimmed(F.col("line"))).where(F.length("line") >= min_chars)
    return rows.withColumn("line", text_hash(F.col("line")))


def document(docs: DataFrame, id: str, text: str) -> Column:
    """Orders documents by id, nulls last, and tells texts under one id apart."""
    own, body = F.col(f"c{position(docs, id)}"), F.col(f"c{position(docs, text)}")
    return F.struct(own.isNull().alias("none"), own.alias("id"), text_hash(body, "document").alias("text"))


def spread(lines: DataFrame, sites: int = SITES) -> tuple[DataFrame, DataFrame]:
    """The lines that occur at least `sites` times, and the hashes of those on as many distinct sites.

    A line that occurs fewer times can't spread, so a plain count goes first. The sites of the others
    are HyperLogLog sketches, one per line and task, merged by aggregation. Where the estimate is
    within the sketch's error of the threshold the sites are counted exactly.
    """
    often = lines.groupBy("line").count().where(F.col("count") >= sites).select("line")
    common = saved(lines.join(saved(often, "often"), "line"), "common")
    sketches = common.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("estimate")
    )
    margin = max(1.0, NEAR * ERROR * sites)
    judged = saved(sketches.where(F.col("estimate") >= sites - margin), "estimates")
    near = F.col("estimate") <= sites + margin
    close = common.join(judged.where(near), "line", "left_semi")
    exact = close.groupBy("line").agg(F.count_distinct("site").alias("n"))
    wide = judged.where(~near).select("line").union(exact.where(F.col("n") >= sites).select("line"))
    return common, saved(wide, "wide")


def cleaned(
    docs: DataFrame, sites: int = SITES, id: str = "doc_id", site: str = "source", text: str = "text",
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """Adds to c0, c1, ... of the input `n_lines`, `n_removed` and `kept_text`.

    A line counts without spaces, tabs and carriage returns at its ends, and from `min_chars` characters.
    Of a line that stands on at least `sites` sites one place stays, the first in the document with the
    smallest id (null ids last); its other places are removed, so that no text is lost altogether.
    Rows with equal id and text are the same document. A null text has no lines and stays null. A
    document may keep no line: its text is then empty. An empty table gives an empty result.
    """
    rows = numbered(docs)
    body = F.col(f"c{position(docs, text)}")
    common, wide = spread(saved(lines_of(docs, id, site, text, min_chars), "lines"), sites)
    places = saved(common.join(wide, "line").select("key", "at", "line").distinct(), "places")
    first = saved(places.groupBy("line").agg(F.min(F.struct("key", "at")).alias("first")), "first")
    gone = places.join(first, "line").where(F.struct("key", "at") != F.col("first"))
    gone = saved(gone.groupBy("key").agg(F.collect_list("at").alias("gone")), "gone")
    joined = rows.withColumn("key", document(docs, id, text)).join(gone, "key", "left")
    joined = joined.withColumn("lines", F.split(body, "\n", -1))
    # A set of places, so that a document with many lines is not gone through once per line.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.transform(left, lambda i: F.get("lines", i))
    return joined.select(
        *[f"c{i}" for i in range(len(docs.columns))],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), body).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )


def report(
    docs: DataFrame, sites: int = SITES, id: str = "doc_id", site: str = "source", text: str = "text",
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """One row per document: its id, `n_lines`, `n_removed` and `kept_text`."""
    own = F.col(f"c{position(docs, id)}").alias("id")
    return cleaned(docs, sites, id, site, text, min_chars).select(own, "n_lines", "n_removed", "kept_text")


def replaced(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """Documents with the lines removed, columns as before; `n_chars`, if there, follows the text."""
    result, body = cleaned(docs, sites), position(docs, "text")
    length = F.length("kept_text").cast("long")
    named = {body: F.col("kept_text")} | {i: length for i, c in enumerate(docs.columns) if c.lower() == "n_chars"}
    return result.select(*[named.get(i, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
