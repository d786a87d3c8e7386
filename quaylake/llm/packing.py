"""Packing of pieces into sequences: dominance reduction, then best fit."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import carried, numbered, position, saved

CAPACITY = 2048


@dataclass
class Plan:
    """Where the pieces of each length go. A segment places the pieces of one length with ranks from
    `low` to below `high`, `each` to a sequence, from sequence `first` on, beginning at `offset`."""

    capacity: int
    left: Counter
    segments: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    ranks: Counter = field(default_factory=Counter)
    sequences: int = 0
    fixed: int = 0

    def place(self, length: int, count: int, first: int, each: int, offset: int) -> None:
        low = self.ranks[length]
        self.segments.append((length, low, low + count, first, each, offset))
        self.ranks[length] += count
        self.left[length] -= count
        if not self.left[length]:
            del self.left[length]

    def fix(self, together: Counter) -> None:
        """As many sequences with exactly these lengths as there are pieces for."""
        many = min(self.left[x] // n for x, n in together.items())
        offset = 0
        for length, n in sorted(together.items(), reverse=True):
            self.place(length, many * n, self.sequences, n, offset)
            offset += length * n
        self.sequences += many
        self.fixed += many

    def dominating(self, j: int) -> Counter | None:
        """A set with a piece of length `j` that dominates every other feasible set with it, if one of
        at most three pieces is found: then some optimal packing has it.

        A set dominates another if the other's pieces can be dealt to its own so that no piece is
        outweighed by those dealt to it; the two can change places in any packing.
        """
        room, others = self.capacity - j, Counter(self.left)
        others[j] -= 1
        sizes = sorted(x for x, n in others.items() if n > 0 and x <= room)
        if not sizes:
            return Counter([j])
        best = sizes[-1]
        small = [x for x in sizes[:3] for _ in range(min(3, others[x]))][:3]
        if best == room or len(small) < 2 or small[0] + small[1] > room:
            return Counter([j, best])
        if len(small) == 3 and sum(small) <= room:
            return None  # sets of four and more: not tried
        pairs = []
        for i, x in enumerate(sizes):
            for y in reversed(sizes[i if others[x] > 1 else i + 1:]):
                if x + y <= room:
                    pairs.append((x, y))
                    break
        most = max((x + y for x, y in pairs), default=0)
        if most <= best:
            return Counter([j, best])
        second = max((x for x in sizes if x + best <= room and (x != best or others[x] > 1)), default=0)
        if second and all(x <= second or x + y <= best for x, y in pairs):
            return Counter([j, best, second])
        return None

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for j in sorted(self.left, reverse=True):
                while self.left[j] > 0 and (together := self.dominating(j)):
                    self.fix(together)
                    changed = True

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room, whole runs of equal lengths and
        equally full sequences at a time."""
        rooms: list[int] = []
        groups: dict[int, list[tuple[int, int]]] = {}

        def put(room: int, first: int, many: int) -> None:
            if many:
                if room not in groups:
                    insort(rooms, room)
                groups.setdefault(room, []).append((first, many))

        for length in sorted(self.left, reverse=True):
            while count := self.left[length]:
                at = bisect_left(rooms, length)
                if at == len(rooms):
                    each = self.capacity // length
                    many = -(-count // each)
                    room, (first, many) = self.capacity, (self.sequences, many)
                    self.sequences += many
                else:
                    room = rooms[at]
                    first, many = groups[room].pop()
                    if not groups[room]:
                        del groups[room], rooms[at]
                    each = room // length
                full = min(many, count // each)
                if full:
                    self.place(length, full * each, first, each, self.capacity - room)
                    put(room - each * length, first, full)
                rest = min(count - full * each, each - 1) if full < many else 0
                if rest > 0:
                    self.place(length, rest, first + full, rest, self.capacity - room)
                    put(room - rest * length, first + full, 1)
                put(room, first + full + (rest > 0), many - full - (rest > 0))


def planned(counts: dict[int, int], capacity: int) -> Plan:
    wrong = [x for x in counts if not 1 <= x <= capacity]
    if wrong:
        raise ValueError(f"lengths outside 1 to {capacity}: {sorted(wrong)[:10]}")
    plan = Plan(capacity, Counter({x: n for x, n in counts.items() if n}))
    plan.reduce()
    plan.best_fit()
    return plan


def packed(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Adds `sequence_id` and `offset`: each item's sequence and its place there, without gaps.

    Only how many items have each length matters, so the plan is made on the driver from at most
    `capacity` counts, whatever the number of items: Martello and Toth's dominance reduction fixes sets
    of up to three items that some optimal packing must have, best fit packs the rest. Then every item
    gets its rank within its length, counted by the partitions of the written input, and finds its
    segment of the plan; the segments are broadcast, being bounded by the capacity as well.

    Lengths must be whole and between 1 and `capacity`; null and others raise an error. Equal rows are
    separate items. An input column named like an added one is replaced. An empty table stays empty.
    """
    spark, size = items.sparkSession, f"c{position(items, length)}"
    rows = numbered(items).withColumn("row", F.monotonically_increasing_id())
    rows = saved(rows.withColumn("part", F.shiftright("row", 33)), "items")
    counts = rows.groupBy(size).count().limit(capacity + 2).collect()
    if any(r[0] is None for r in counts):
        raise ValueError("a length is null")
    plan = planned({int(r[0]): r[1] for r in counts}, capacity)
    segments = F.broadcast(spark.createDataFrame(
        plan.segments, "size long, low long, high long, first long, each long, begin long"
    ))
    blocks = rows.groupBy(size, "part").count()
    before = Window.partitionBy(size).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(size, "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy(size, "part").orderBy("row")) - 1
    # The blocks grow with the partitions, so they are met by sorting, in the order that is there already.
    ranked = rows.withColumn("within", within).join(saved(blocks, "blocks").hint("merge"), [size, "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    met = (F.col(size) == F.col("size")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    step = F.col("rank") - F.col("low")
    result = ranked.join(segments, met).withColumns({
        "sequence_id": F.expr("first + (rank - low) div each"),
        "offset": F.col("begin") + (step % F.col("each")) * F.col(size),
    })
    return carried(items, result, ["sequence_id", "offset"])
