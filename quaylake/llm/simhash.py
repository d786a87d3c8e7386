"""Near duplicates by SimHash fingerprints and multi-index hashing.

Two sizes of fingerprints: 64 bits of a text's 3-word shingles, linked exactly within a distance (`linked`), and
wide ones of a shingle set (`wide`), whose segments propose pairs of similar sets (`probes`, `close`).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType

from quaylake.llm.common import components, numbered, picked, position, saved

SEED = 42
SHINGLE = 3
DISTANCE = 2
SEGMENTS = 2
BUCKET = 32
BLOCK = 255  # rows whose bits add up within one byte
# Wide fingerprints: PARTS segments of WIDTH bits, the LOOSE least certain ones of each segment tried both ways.
# Sets that share 0.8 of their shingles differ in 15 % of the bits; they meet in a segment with probability 0.147,
# and in none of all with one in 100,000. Unlike sets differ in half the bits, and by chance meet in one of
# PARTS * 4^LOOSE / 2^WIDTH = 1 / 58,000 of all pairs.
PARTS, WIDTH, LOOSE = 72, 28, 3
FAR = PARTS * WIDTH // 5  # pairs further apart are not compared: 15 % of the bits and six standard deviations
STEPS = np.arange(1, PARTS // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def fingerprint_of(text: bytes, width: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text in UTF-8: ASCII letters lowered, shingles of `width` words,
    repeats included; fewer words are one shingle, none gives 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    last = (ends[min(width, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes, n = np.zeros(64, np.int64), len(last)
    for low in range(0, n, 1 << 16):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[low:low + (1 << 16)], last[low:low + (1 << 16)])]
        rows = np.zeros((-(-len(part) // BLOCK) * BLOCK, 8), np.uint8)
        rows[:len(part)] = np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1).reshape(-1, BLOCK, 64)
        votes += bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n).view(">i8")[0])


@F.arrow_udf(LongType())
def fingerprints(text: pa.Array) -> pa.Array:
    return pa.array([fingerprint_of(t or b"") for t in text.to_pylist()], pa.int64())


def fingerprint(text: Column) -> Column:
    return fingerprints(text.cast("binary"))


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def segments(distance: int = DISTANCE, parts: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment. Two fingerprints within `distance` are within the
    radius in at least one segment: the radii and the number of segments add up to distance + 1."""
    base, over = divmod(distance, parts)
    edges = [64 * i // parts for i in range(parts + 1)]
    radii = [base if i <= over else base - 1 for i in range(parts)]
    return [(a, b - a, r) for a, b, r in zip(edges, edges[1:], radii) if r >= 0]


def ball(width: int, radius: int) -> list[int]:
    """Masks of at most `radius` of `width` bits."""
    picks = [c for r in range(radius + 1) for c in combinations(range(width), r)]
    return [sum(1 << b for b in c) for c in picks]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def linked(prints: DataFrame, distance: int = DISTANCE, parts: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (`fp`, distinct rows) within `distance` bits
    of each other: not every pair, but no connection is lost.

    Every fingerprint is a member of one table per segment, under the segment's value, and probes
    the values in a small Hamming ball round its own. Members that a probe meets are compared in
    full. A value held by more than `bucket` members is not listed: whoever probes it goes on to the
    exact way, in which each fingerprint names all points within half the distance. Those that name
    one point are within the distance of each other, so each is linked to the smallest of them; the
    work stays in proportion to the members, where pairs would be their square.
    """
    if distance % 2:
        raise ValueError("distance must be even")
    shape = segments(distance, parts)

    def value(shift: int, width: int) -> Column:
        moved = F.shiftrightunsigned("fp", shift)
        return moved if width == 64 else moved.bitwiseAND(F.lit((1 << width) - 1))

    own = [F.struct(F.lit(i).alias("part"), value(s, w).alias("value")) for i, (s, w, _) in enumerate(shape)]
    near = [
        F.struct(F.lit(i).alias("part"), value(s, w).bitwiseXOR(F.lit(signed(mask))).alias("value"))
        for i, (s, w, r) in enumerate(shape) for mask in ball(w, r)
    ]
    members = prints.select("fp", F.inline(F.array(*own)))
    probes = prints.select(F.col("fp").alias("probe"), F.inline(F.array(*near)))
    sizes = members.groupBy("part", "value").count()
    full = saved(sizes.where(F.col("count") > bucket).select("part", "value"), "full")
    listed = members.join(full, ["part", "value"], "left_anti").select("part", "value", "fp")
    table = listed.unionByName(full.withColumn("fp", F.lit(None).cast("long")))
    apart = F.bit_count(F.col("probe").bitwiseXOR(F.col("fp")))
    meets = F.col("fp").isNull() | ((F.col("probe") < F.col("fp")) & (apart <= distance))
    # Many probes come from one row, which the optimizer doesn't reckon with: none of this is broadcast.
    found = probes.join(saved(table, "table").hint("merge"), ["part", "value"]).where(meets).select("probe", "fp")
    found = saved(found.distinct(), "found")
    pairs = found.where("fp IS NOT NULL").select(F.col("probe").alias("a"), F.col("fp").alias("b"))
    crowd = found.where("fp IS NULL").select("probe")
    points = F.explode(F.array(*[F.col("probe").bitwiseXOR(F.lit(signed(m))) for m in ball(64, distance // 2)]))
    named = crowd.select("probe", points.alias("point"))
    least = named.groupBy("point").agg(F.min("probe").alias("low"), F.max("probe").alias("high")).where("low < high")
    stars = named.join(saved(least.select("point", "low"), "points").hint("merge"), "point").where("low < probe")
    return pairs.union(stars.select("probe", "low"))


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, `fingerprint` (16 hex digits) and `component_id`, the smallest id
    among the documents that a chain of links reaches, itself included.

    Null and empty texts have fingerprint zero, linked like any other. A null id is passed over in the
    minimum; a component with none but null ids has a null component. Equal rows are all kept. Other
    columns of the input don't matter. An empty table gives an empty result.
    """
    rows = picked(docs, id=id, text=text).select("id", fingerprint(F.col("text")).alias("fp"))
    marked = saved(rows, "prints")
    prints = saved(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(linked(prints.select("fp")))
    named = prints.join(roots, prints.fp == roots.node, "left")
    named = saved(named.select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = saved(named.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    labels = saved(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "labels")
    return marked.join(labels, "fp").select(
        F.col("id").alias(id), as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def wide(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of a set of 64-bit hashes in PARTS segments, and in each segment the places of the LOOSE bits
    with the closest votes: those that a similar set most likely has otherwise."""
    n, votes = len(found), np.zeros(PARTS * 32, np.int64)
    for low in range(0, n, BLOCK):
        x = found[low:low + BLOCK, None] + STEPS
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(31))).astype("<u8").view(np.uint8)
        votes += np.unpackbits(x, axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    lead = 2 * votes.reshape(PARTS, 32)[:, :WIDTH] - n
    value = (lead > 0) @ (np.int64(1) << np.arange(WIDTH))
    order = np.abs(lead) * WIDTH + np.arange(WIDTH)
    return value.astype("<u4"), np.argpartition(order, LOOSE, axis=1)[:, :LOOSE].astype(np.uint8)


def probes(low: int, high: int):
    """Function of wide fingerprints and their loose places (binary): the values to meet under in the segments
    from `low` to before `high`, all settings of the loose bits, with the segment's number in front."""

    @F.arrow_udf(ArrayType(LongType()))
    def keys(prints: pa.Array, loose: pa.Array) -> pa.Array:
        has = [bool(p) for p in prints.to_pylist()]
        value = np.frombuffer(b"".join(prints.to_pylist()), "<u4").reshape(-1, PARTS)[:, low:high].astype(np.int64)
        mask = np.int64(1) << np.frombuffer(b"".join(loose.to_pylist()), np.uint8).reshape(-1, PARTS, LOOSE)[:, low:high].astype(np.int64)
        base = (value & ~mask.sum(axis=2)) | (np.arange(low, high) << WIDTH)
        tried = (mask[:, :, None, :] * ((np.arange(1 << LOOSE)[:, None] >> np.arange(LOOSE)) & 1)).sum(axis=3)
        flat = (base[:, :, None] | tried).reshape(-1)
        ends = np.cumsum([0, *((high - low << LOOSE) * h for h in has)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))

    return keys


@F.arrow_udf(BooleanType())
def close(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two wide fingerprints are no more than FAR bits apart."""
    left, right = (np.frombuffer(b"".join(side.to_pylist()), "<u4").reshape(-1, PARTS) for side in (a, b))
    return pa.array(np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64) <= FAR, pa.bool_())


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keeps one document of each component, the one with the smallest id; nulls come last and among
    equal ids one row stays. Columns are those of the input."""
    plain, key = numbered(docs), f"c{position(docs, id)}"
    marked = plain.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "fp", fingerprint(F.col(f"c{position(docs, text)}"))
    )
    marked = saved(marked, "prints")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("row"))
    prints = saved(marked.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    roots = components(linked(prints.select("fp")))
    named = prints.join(roots, prints.fp == roots.node, "left")
    first = named.groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first"))
    kept = saved(first.select(F.col("first.row").alias("row")), "kept")
    # Sorted on both sides whatever their size: texts are moved once either way at scale.
    return marked.join(kept.hint("merge"), "row", "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
