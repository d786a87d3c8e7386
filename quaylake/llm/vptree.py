"""Nearest neighbours by a vantage-point tree per shard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import picked, saved

SHARD_ROWS = 4096
LEAF = 128
SEED = 42
ROUNDING = 1e-9  # relative slack, so that no rounding prunes a tie


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distance of each query to each point, added up in the order of the components."""
    total = np.zeros((len(queries), len(points)))
    for j in range(points.shape[1]):
        step = queries[:, j, None] - points[None, :, j]
        total += step * step
    return np.sqrt(total)


class Tree:
    """Distinct vectors of a shard, in order of their smallest id, and a tree over them.

    Of the rows that share a vector only the `most` first in order of id are kept: more of them can be
    in no result of fewer rows. So a vector that fills a shard costs no more than any other.
    """

    def __init__(self, points: np.ndarray, owners: list[tuple], most: int) -> None:
        order = sorted(range(len(owners)), key=owners.__getitem__)
        found: dict[bytes, list[tuple]] = {}
        first = []
        for i in order:
            key = points[i].tobytes()
            if key not in found:
                first.append(i)
            same = found.setdefault(key, [])
            if len(same) < most:
                same.append(owners[i])
        self.points, self.owners = points[first], list(found.values())
        self.square = (self.points * self.points).sum(axis=1)
        self.random = np.random.default_rng(SEED)
        self.root = self.node(np.arange(len(first)))

    def node(self, inside: np.ndarray):
        if len(inside) <= LEAF:
            return inside
        at = int(self.random.integers(len(inside)))
        rest = np.delete(inside, at)
        far = distances(self.points[inside[at]][None], self.points[rest])[0]
        radius = float(np.median(far))
        near = far <= radius
        if near.all() or not near.any():
            return inside
        return int(inside[at]), radius, self.node(rest[near]), self.node(rest[~near])

    def search(self, queries: np.ndarray, most: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and indexes of the nearest vectors, nearest first, ties by index; missing ones are
        infinitely far. A part of the tree is left out if `factor` times its least possible distance is
        more than the worst one held: one is exact, more is faster and may miss some."""
        best = np.full((len(queries), most), np.inf)
        which = np.full((len(queries), most), len(self.owners))

        square = (queries * queries).sum(axis=1)

        def offer(active: np.ndarray, candidates: np.ndarray) -> np.ndarray:
            far = distances(queries[active], self.points[candidates])
            keep(active, candidates, far)
            return far

        def offer_many(active: np.ndarray, candidates: np.ndarray) -> None:
            """As `offer`, but a product of matrices first leaves out what is surely too far."""
            size = square[active][:, None] + self.square[candidates][None, :]
            rough = size - 2 * (queries[active] @ self.points[candidates].T)
            worst = best[active, -1] ** 2
            near = rough <= worst[:, None] + ROUNDING * (size + 1)
            some = np.flatnonzero(near.any(axis=1))
            if not len(some):
                return
            row, column = np.nonzero(near[some])
            left, right = queries[active[some[row]]], self.points[candidates[column]]
            total = np.zeros(len(row))
            for j in range(queries.shape[1]):
                step = left[:, j] - right[:, j]
                total += step * step
            far = np.full((len(some), len(candidates)), np.inf)
            far[row, column] = np.sqrt(total)
            keep(active[some], candidates, far)

        def keep(active: np.ndarray, candidates: np.ndarray, far: np.ndarray) -> None:
            both = np.concatenate([best[active], far], axis=1)
            index = np.concatenate([which[active], np.broadcast_to(candidates, far.shape)], axis=1)
            order = np.lexsort((index, both), axis=1)[:, :most]
            best[active] = np.take_along_axis(both, order, axis=1)
            which[active] = np.take_along_axis(index, order, axis=1)

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    offer_many(active, node)
                return
            at, radius, near, far = node
            away = offer(active, np.array([at]))[:, 0]
            inside = away <= radius
            for mine, first, second in ((inside, near, far), (~inside, far, near)):
                group, bound = active[mine], np.abs(away[mine] - radius)
                visit(first, group)
                worst = best[group, -1]
                visit(second, group[factor * bound * (1 - ROUNDING) <= worst])

        visit(self.root, np.arange(len(queries)))
        return best, which


def usable(vector: Column) -> Column:
    """Not null, no component null or not finite, not zero throughout."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def nearest(
    rows: DataFrame, queries: Column, k: int = 10, factor: float = 1.0, shard_rows: int = SHARD_ROWS,
    id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """For each row for which `queries` (a condition on the column `id`) holds, its `k` nearest other
    rows: `query_id`, `rank` (from 1), `vec_id`, `score`, the Euclidean distance in double precision.

    Vectors that are null, zero or hold null or non-finite components take no part, as queries or as
    candidates. Vectors of different lengths are not compared. Ties go to the smaller id, null ids last.
    A query's own row is no candidate of its own; other rows with its id or its vector are. A query
    with fewer candidates gets them all, an empty table gives an empty result, other columns don't
    matter.

    Rows are dealt to shards by a hash of their place in the written table, so that no vector or id
    can fill one. The queries, a stated share of the rows, go to every shard, where they stream past
    the tree in blocks; a task holds one shard. The shards' results are merged by rank.
    """
    table = picked(rows, id=id, vector=vector).withColumn("vector", F.col("vector").cast("array<double>"))
    table = saved(table.where(usable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id()), "vectors")
    shards = max(1, math.ceil(table.count() / shard_rows))
    points = table.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).withColumn("kind", F.lit(0))
    asked = table.where(queries).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = points.unionByName(asked.withColumn("kind", F.lit(1))).withColumn("size", F.size("vector"))
    both = both.repartitionById(shards, "shard").sortWithinPartitions("shard", "size", "kind", "row")
    kind = table.schema["id"].dataType.simpleString()
    schema = f"query_row long, query_id {kind}, row long, vec_id {kind}, score double"
    names = ["query_row", "query_id", "row", "vec_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, owners, tree = None, [], [], None
        for batch in batches:
            group = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "size", "kind")]
            change = np.flatnonzero(np.any([g[1:] != g[:-1] for g in group], axis=0)) + 1
            for low, high in zip([0, *change], [*change, batch.num_rows]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                here = (group[0][low], group[1][low])
                if here != key:
                    key, held, owners, tree = here, [], [], None
                vectors = part.column("vector").flatten().to_numpy().reshape(high - low, -1)
                ids, places = part.column("id").to_pylist(), part.column("row").to_pylist()
                if group[2][low] == 0:
                    held.append(vectors)
                    owners += [(i is None, i, r) if i is not None else (True, 0, r) for i, r in zip(ids, places)]
                    continue
                if not held:
                    continue
                tree = tree or Tree(np.concatenate(held), owners, k + 1)
                best, which = tree.search(vectors, k + 1, factor)
                out: list[tuple] = []
                for query, place, far, index in zip(ids, places, best, which):
                    mine: list[tuple] = []
                    for d, at in zip(far, index):
                        if not np.isfinite(d) or (len(mine) >= k and d > mine[-1][-1]):
                            break
                        mine += [(place, query, r, None if none else i, float(d)) for none, i, r in tree.owners[at] if r != place]
                    mine.sort(key=lambda x: (x[4], x[3] is None, x[3] if x[3] is not None else 0, x[2]))
                    out += mine[:k]
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), ids_type(batch), pa.int64(), ids_type(batch), pa.float64()))],
                    names=names,
                )

    def ids_type(batch: pa.RecordBatch) -> pa.DataType:
        return batch.schema.field("id").type

    found = both.select("shard", "size", "kind", "id", "row", "vector").mapInArrow(search, schema)
    order = Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
