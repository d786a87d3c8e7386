"""Compression of vectors to codes: Lloyd's rounds per part, with cover trees that assign whole subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from quaylake.llm.common import picked, saved
from quaylake.session import broadcast_if_small

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
CHUNK = 2048  # vectors that share their trees
LEAF = 16  # points that are not parted further
LIMIT = 1 << 26  # of the integers: squared distances of vectors then fit 64 bits
ROUNDING = 1e-9  # relative slack, so that no rounding decides a tie

TREE = StructType([StructField(name, BinaryType()) for name in ("order", "center", "radius", "span")])


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of each point to each entry."""
    total = np.zeros((len(points), len(entries)), np.int64)
    for j in range(points.shape[1]):
        step = points[:, j, None] - entries[None, :, j]
        total += step * step
    return total


class Tree:
    """Cover tree over the rows of `points`: a node's children cover its points within half its radius, and
    their centres are further apart than that. `order` lists the points so that every node has a span of
    them, `total` are their cumulative sums, so a span's sum is a difference."""

    def __init__(self, points: np.ndarray, order: np.ndarray, center: np.ndarray, radius: np.ndarray, span: np.ndarray):
        self.order, self.center, self.radius, self.span = order, center, radius, span
        self.points = points[order]
        self.total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(self.points, axis=0)])

    @classmethod
    def over(cls, points: np.ndarray) -> Tree:
        order, center, radius, span = np.arange(len(points)), [0], [], []
        waiting = [(0, len(points), 0)]
        done = 0
        while done < len(waiting):  # nodes in the order of their levels: a node's children are neighbours
            begin, end, middle = waiting[done]
            inside = order[begin:end]
            near = squared(points[inside], points[middle][None])[:, 0]
            reach = float(np.sqrt(near.max()))
            radius.append(reach * (1 + ROUNDING))
            children: list[tuple[int, int, int]] = []
            if end - begin > LEAF and reach > 0:
                owner, centers = np.zeros(len(inside), np.int64), [middle]
                while 4 * near.max() > reach * reach:  # the farthest point from all centres is the next
                    centers.append(int(inside[near.argmax()]))
                    found = squared(points[inside], points[centers[-1]][None])[:, 0]
                    closer = found < near
                    near[closer], owner[closer] = found[closer], len(centers) - 1
                order[begin:end] = inside[np.argsort(owner, kind="stable")]
                ends = begin + np.cumsum(np.bincount(owner, minlength=len(centers)))
                children = list(zip([begin, *ends[:-1].tolist()], ends.tolist(), centers))
            span.append((begin, end, len(waiting), len(children)))
            waiting += children
            done += 1
        return cls(points, order, points[[w[2] for w in waiting]], np.array(radius), np.array(span))

    def assigned(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest entry of each point, the lower of equal ones, and the entries' sums and counts.

        A node whose centre is nearer to one entry than to any other by more than twice its radius belongs
        to that entry as a whole. Any other is opened; the points of an open leaf are compared one by one."""
        label = np.zeros(len(self.points), np.int64)  # in the order of the tree
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        nodes, single = np.arange(min(1, len(self.points))), []
        while len(nodes):
            far = squared(self.center[nodes], entries)
            best = far.argmin(axis=1)
            rows = np.arange(len(nodes))
            first = np.sqrt(far[rows, best])
            far[rows, best] = np.iinfo(np.int64).max
            others = np.sqrt(far.min(axis=1))
            radius = self.radius[nodes]
            sure = (first + 2 * radius < others * (1 - ROUNDING)) | (radius == 0)
            for (begin, end), entry in zip(self.span[nodes[sure], :2].tolist(), best[sure].tolist()):
                label[begin:end] = entry
                sums[entry] += self.total[end] - self.total[begin]
                counts[entry] += end - begin
            begin, end, child, many = self.span[nodes[~sure]].T
            single += [np.arange(b, e) for b, e in zip(begin[many == 0], end[many == 0])]
            child, many = child[many > 0], many[many > 0]
            nodes = np.repeat(child - (np.cumsum(many) - many), many) + np.arange(many.sum())
        if single:
            at = np.concatenate(single)
            label[at] = squared(self.points[at], entries).argmin(axis=1)
            np.add.at(sums, label[at], self.points[at])
            counts += np.bincount(label[at], minlength=len(entries))
        found = np.empty_like(label)
        found[self.order] = label
        return found, sums, counts

    def packed(self) -> dict[str, bytes]:
        return {"order": self.order.astype("<i4").tobytes(), "center": self.center.astype("<i4").tobytes(),
                "radius": self.radius.astype("<f8").tobytes(), "span": self.span.astype("<i4").tobytes()}

    @classmethod
    def unpacked(cls, points: np.ndarray, kept: dict[str, bytes]) -> Tree:
        read = {name: np.frombuffer(kept[name], "<i4").astype(np.int64) for name in ("order", "center", "span")}
        return cls(points, read["order"], read["center"].reshape(-1, points.shape[1]),
                   np.frombuffer(kept["radius"], "<f8"), read["span"].reshape(-1, 4))


def parted(points: bytes, dims: int) -> list[np.ndarray]:
    """The parts of a chunk's vectors."""
    whole = np.frombuffer(points, "<i4").astype(np.int64).reshape(-1, dims)
    return np.split(whole, PARTS, axis=1)


def usable(vector: Column) -> Column:
    """Vectors without a null or non-finite component; an empty one has no parts."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def chunks(rows: DataFrame, dims: int) -> DataFrame:
    """Every CHUNK vectors of a partition with their ids, labels and one tree per part."""
    kinds = [rows.schema[name].dataType for name in ("id", "label")]
    schema = StructType([
        StructField("ids", ArrayType(kinds[0])), StructField("labels", ArrayType(kinds[1])),
        StructField("points", BinaryType()), StructField("trees", ArrayType(TREE)),
    ])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            vector = table["vector"].chunk(0)
            if any(n != dims for n in vector.value_lengths().to_pylist()):
                raise ValueError(f"all vectors must have {dims} components")
            exact = np.floor(vector.flatten().to_numpy().astype(np.float64) * SCALE)
            if (np.abs(exact) >= LIMIT).any():
                raise ValueError(f"components must be below {LIMIT // SCALE}: squared distances would not fit 64 bits")
            points = exact.astype("<i4").tobytes()
            trees = [Tree.over(part).packed() for part in parted(points, dims)]
            return pa.RecordBatch.from_pylist(
                [{"ids": table["id"].to_pylist(), "labels": table["label"].to_pylist(), "points": points, "trees": trees}],
                schema=pa.schema([("ids", pa.list_(table["id"].type)), ("labels", pa.list_(table["label"].type)),
                                  ("points", pa.binary()), ("trees", pa.list_(pa.struct([(f.name, pa.binary()) for f in TREE])))]),
            )

        room = CHUNK
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, room)
                held.append(part)
                at, room = at + part.num_rows, room - part.num_rows
                if not room:
                    yield chunk()
                    held, room = [], CHUNK
        if held:
            yield chunk()

    return saved(rows.mapInArrow(build, schema), "trees")


def next_entries(trees: DataFrame, books: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """The books after a round: floor of the mean of each entry's points; unused entries stay."""
    width = dims // PARTS + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(book), width), np.int64) for book in books]
        for batch in batches:
            for points, kept in zip(batch.column("points").to_pylist(), batch.column("trees").to_pylist()):
                for part, tree, book, own in zip(parted(points, dims), kept, books, total):
                    _, sums, counts = Tree.unpacked(part, tree).assigned(book)
                    own[:, :-1] += sums
                    own[:, -1] += counts
        value = np.concatenate([t.ravel() for t in total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value), dtype=np.int32)), pa.array(value)], names=["slot", "value"])

    found = trees.select("points", "trees").mapInArrow(add, "slot int, value long").groupBy("slot").agg(F.sum("value").alias("value"))
    value = dict(found.collect())  # PARTS * ENTRIES * width numbers at most
    out, slot = [], 0
    for book in books:
        new = book.copy()
        for e in range(len(book)):
            row = [value[slot + j] for j in range(width)]
            slot += width
            if row[-1]:
                new[e] = [s // row[-1] for s in row[:-1]]
        out.append(new)
    return out


def compressed(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per usable vector: its id, `code` (two hex digits per part), `error` (squared distance to
    what the code stands for), `label_error` (the error of its label) and `codebooks_sha256`.

    A component x counts as floor(SCALE * x); a vector has PARTS equal parts. The entries of a part begin as
    those of the ENTRIES vectors with the smallest ids (nulls last, of equal ids the smaller vector) and go
    through ROUNDS rounds of Lloyd. All numbers are integers, so the result depends on no order. Fewer
    vectors give fewer entries. Null vectors, empty ones and those with a null or non-finite component take
    no part; repeated rows all do. Vectors of several lengths, a length that PARTS doesn't divide and
    components from LIMIT / SCALE on are errors. An empty table gives an empty result, other columns don't
    matter. Null labels are one label. The trees are built once, as a table in the shared folder, and read by
    every round; only the entries' sums and counts come to the driver.
    """
    rows = picked(vectors, id=id, label=label, vector=vector).where(usable(F.col("vector")))
    out = StructType([
        StructField("id", rows.schema["id"].dataType), StructField("label", rows.schema["label"].dataType),
        StructField("code", StringType()), StructField("error", LongType()),
    ])
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    dims = len(first[0][0]) if first else PARTS
    if dims % PARTS or any(len(v) != dims for v, in first):
        raise ValueError(f"vectors must have one length, a multiple of {PARTS}")
    start = np.floor(np.array([v for v, in first], np.float64).reshape(-1, dims) * SCALE)
    if (np.abs(start) >= LIMIT).any():
        raise ValueError(f"components must be below {LIMIT // SCALE}: squared distances would not fit 64 bits")
    books = np.split(start.astype(np.int64), PARTS, axis=1)
    trees = chunks(rows, dims)
    for _ in range(ROUNDS if first else 0):
        books = next_entries(trees, books, dims)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (points, kept) in enumerate(zip(batch.column("points").to_pylist(), batch.column("trees").to_pylist())):
                codes, error = [], 0
                for part, tree, book in zip(parted(points, dims), kept, books):
                    entry = Tree.unpacked(part, tree).assigned(book)[0]
                    error = error + ((part - book[entry]) ** 2).sum(axis=1)
                    codes.append(entry.astype(np.uint8))
                text = np.stack(codes, axis=1).tobytes().hex()
                code = [text[k:k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]
                own = [batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(code, pa.string()), pa.array(error)], names=out.names)

    coded = saved(trees.mapInArrow(assign, out), "codes")
    # A label may hold a third of all rows: sums per task first, then a small table or a join that splits.
    sums = saved(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")), "labels")
    both = coded.join(broadcast_if_small(sums), F.col("label").eqNullSafe(F.col("same")))
    text = ",".join(str(x) for book in books for x in book.ravel().tolist())
    digest = hashlib.sha256(text.encode()).hexdigest()
    return both.select(F.col("id").alias(id), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
