"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quaylake.llm.common import carried, numbered, saved

SHARDS = 16
SEED = 42
EXACT = 10**9  # numpy's own sampler takes fewer


def drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of `n` drawn without replacement are good, by inversion round the mode."""
    low, high = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    total = good + bad
    spread = math.sqrt(n * (good / total) * (bad / total) * max(total - n, 0) / max(total - 1, 1))
    low, high = max(low, int(mode - 12 * spread - 20)), min(high, int(mode + 12 * spread + 20))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(chances, rng.random() * chances[-1], side="right"))


def dealt(rng: np.random.Generator, sizes: np.ndarray, n: int) -> np.ndarray:
    """How many of `n` drawn without replacement are of each kind; `sizes` says how many there are."""
    if len(sizes) == 1:
        return np.array([n], np.int64)
    if sizes.sum() < EXACT:
        return rng.multivariate_hypergeometric(sizes, n, method="marginals")
    half = len(sizes) // 2
    left = drawn(rng, int(sizes[:half].sum()), int(sizes[half:].sum()), int(n))
    return np.concatenate([dealt(rng, sizes[:half], left), dealt(rng, sizes[half:], n - left)])


def matrix_row(counts: np.ndarray, sizes: np.ndarray, place: int, seed: int) -> np.ndarray:
    """One row of the matrix: how many rows of partition `place` go to each cell.

    The partitions are halved again and again and what each half sends is drawn with a seed of its own,
    so that every task finds its row alone and all rows agree: columns add up to `sizes`, rows to
    `counts`. The matrix is nowhere held as a whole.
    """
    ends = np.concatenate([[0], np.cumsum(counts)])
    low, high = 0, len(counts)
    while high - low > 1:
        half = (low + high) // 2
        left = dealt(np.random.default_rng([seed, low, high]), sizes, int(ends[half] - ends[low]))
        low, high, sizes = (low, half, left) if place < half else (half, high, sizes - left)
    return sizes


def shares(n: int, parts: int) -> np.ndarray:
    """Sizes that add up to n, at most one apart, larger ones first."""
    return n // parts + (np.arange(parts) < n % parts).astype(np.int64)


def cell_sizes(n: int, shards: int, each: int) -> np.ndarray:
    return np.concatenate([shares(int(size), each) for size in shares(n, shards)])


def sharded(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds `shard` and `slot` (from 0, without gaps within a shard): a uniformly random order of all
    rows in shards whose sizes are at most one apart.

    The rows are written once, which fixes each row's partition and place. A shard is cut into cells,
    about the square root of the number of rows in all, so that no task holds a shard. How many rows
    each partition sends to each cell is drawn exactly (see `matrix_row`); a partition deals its rows
    out by a random permutation, the rows are exchanged by cell, and each cell is permuted again. One
    count per partition reaches the driver.

    Equal rows are separate rows and nulls don't matter. Column names of the result replace equal names
    of the input, in any case. An empty table stays empty. The same rows in the same partitions with
    the same seed give the same order.
    """
    rows = saved(numbered(df).withColumn("at", F.monotonically_increasing_id()), "rows")
    found = rows.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect()
    places = {r["part"]: i for i, r in enumerate(found)}
    counts = np.array([r["count"] for r in found], np.int64)
    n = int(counts.sum())
    each = max(1, math.ceil(math.sqrt(n) / shards))
    sizes = cell_sizes(n, shards, each)
    held: dict[int, np.ndarray] = {}

    def labels(part: int) -> np.ndarray:
        if part not in held:
            held.clear()
            row = matrix_row(counts, sizes, places[part], seed)
            cells = np.repeat(np.arange(len(sizes), dtype=np.int32), row)
            held[part] = np.random.default_rng([seed, part]).permutation(cells)
        return held[part]

    @F.arrow_udf(IntegerType())
    def cell(at: pa.Array) -> pa.Array:
        ids = at.to_numpy(zero_copy_only=False)
        parts, places_in = ids >> 33, ids & ((1 << 33) - 1)
        out = np.empty(len(ids), np.int32)
        for part in np.unique(parts).tolist():
            mine = parts == part
            out[mine] = labels(part)[places_in[mine]]
        return pa.array(out)

    dealt_rows = rows.withColumn("cell", cell("at")).withColumn("key", F.xxhash64(F.lit(seed), "at"))
    order = F.row_number().over(Window.partitionBy("cell").orderBy("key", "at")) - 1
    shard, inner = F.expr(f"cell div {each}").cast("int"), F.col("cell") % each
    size = F.lit(n // shards) + F.when(F.col("shard") < n % shards, 1).otherwise(0)
    before = inner * F.expr(f"size div {each}") + F.least(inner, F.col("size") % each)
    result = dealt_rows.withColumn("order", order).withColumn("shard", shard).withColumn("size", size)
    return carried(df, result.withColumn("slot", (before + F.col("order")).cast("long")), ["shard", "slot"])
