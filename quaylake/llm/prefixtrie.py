"""Prefix trie of conversations, and sums over its subtrees by centroid decomposition."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import picked, saved, words_of

FAMILY = 20  # conversations c - c % FAMILY lend their first turns to the others
SHARED = 4  # up to this many turns, less one, are lent
LARGE = 4096  # a component with more than 1 / LARGE of all weight is large: there are fewer than LARGE of them
SMALL = 1024  # components of at most this weight, so of at most as many nodes, are finished within one task
BLOCK = 8192  # rows of small components that are looked at together
RUN = 8192  # ids that are written as one text
NOTHING = hashlib.sha256(b"").hexdigest()


def ranked(conversations: DataFrame, id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns (`id`, `part`, `local`, `a`, `b`, `words`) and the parts of each conversation (`id`, `part`,
    `before`, `n`): a turn's place is `before` + `local`. Texts stay behind, two hashes stand for them.

    Turns are dealt by ranges, so that a conversation of any length is many parts and never one task's."""
    rows = picked(conversations, id=id, turn=turn, role=role, text=text).where("id IS NOT NULL")
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    rows = rows.select(
        F.col("id").cast("long").alias("id"), "turn", F.xxhash64(*said).alias("a"), F.xxhash64(F.lit("second"), *said).alias("b"),
        F.size(words_of(said[1])).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), "a", "b"]
    rows = saved(rows.repartitionByRange("id", *order).withColumn("part", F.spark_partition_id()), "turns")
    local = rows.withColumn("local", F.row_number().over(Window.partitionBy("id", "part").orderBy(*order)))
    parts = rows.groupBy("id", "part").count()
    earlier = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "id", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"),
        F.sum("count").over(Window.partitionBy("id")).alias("n"),
    )
    return saved(local.drop("turn"), "local"), saved(parts, "parts")


def rebuilt(conversations: DataFrame, id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (`id`, `part`, `place` from 1, `a`, `b`, `words`, `length`) and the
    conversations (`id`, `length`): the first turns of the family's first one, then the own ones after them."""
    turns, parts = ranked(conversations, id, turn, role, text)
    lent = F.crc32(F.col("id").cast("string").cast("binary")) % SHARED
    sizes = parts.select("id", "n").distinct().withColumn("lent", lent).withColumn("first", F.col("id") - F.col("id") % FAMILY)
    givers = sizes.select(F.col("id").alias("first"), F.col("n").alias("given"))
    sizes = sizes.join(givers, "first", "left").withColumn("given", F.least("lent", F.coalesce("given", F.lit(0))))
    sizes = sizes.withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("lent"), F.lit(0)))
    sizes = saved(sizes.select("id", "first", "lent", "given", "length"), "sizes")
    placed = turns.join(parts.join(sizes, "id"), ["id", "part"]).withColumn("at", F.col("before") + F.col("local"))
    placed = saved(placed.select("id", "part", "at", "a", "b", "words", "lent", "given", "length"), "placed")
    own = placed.where("at > lent").withColumn("place", F.col("at") - F.col("lent") + F.col("given"))
    heads = placed.where(F.col("at") < SHARED).select(F.col("id").alias("first"), F.col("at").alias("place"), "a", "b", "words")
    heads = sizes.join(heads, "first").where("place <= lent").withColumn("part", F.lit(-1))
    columns = ["id", "part", "place", "a", "b", "words", "length"]
    return own.select(columns).unionByName(heads.select(columns)), sizes.select("id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Rows (`id`, `depth`, `ha`, `hb`, `pa`, `pb`, `words`, `length`): the hash of each prefix and of the one
    before it. A prefix's hash is the exclusive or of its turns' hashes, each taken with its place, so that it
    adds up over parts."""
    own = turns.select(
        "id", "part", F.col("place").alias("depth"), "words", "length",
        F.xxhash64("place", "a", "b").alias("xa"), F.xxhash64("b", "place", "a", F.lit("second")).alias("xb"),
    )
    own = saved(own, "hashed")
    parts = own.groupBy("id", "part").agg(*[F.bit_xor(x).alias(x) for x in ("xa", "xb")])
    earlier = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("id", "part", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(f"before_{x}") for x in ("xa", "xb")])
    run = Window.partitionBy("id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = own.select("*", *[F.bit_xor(x).over(run).alias(f"run_{x}") for x in ("xa", "xb")])
    both = own.join(parts, ["id", "part"])
    for h, p, x in (("ha", "pa", "xa"), ("hb", "pb", "xb")):
        both = both.withColumn(h, F.col(f"run_{x}").bitwiseXOR(F.col(f"before_{x}"))).withColumn(p, F.col(h).bitwiseXOR(F.col(x)))
    return saved(both.select("id", "depth", "ha", "hb", "pa", "pb", "words", "length"), "prefixes")


def trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and the way to each conversation (`id`, `depth`, `rep`, `up`, `last`): the node at each depth,
    the node above it, and whether the conversation ends there. A node is known by its smallest member `rep`
    and its depth. Its `weight` is the sum of `n_convs` over its subtree: the prefixes of its members from its
    depth on, for which one aggregation is enough."""
    root = conversations.agg(F.min("id"), F.count(F.lit(1)), F.sum(F.col("length") + 1), F.max("length")).first()
    least, many, weight, longest = root
    rows = prefixes(turns)
    nodes = rows.groupBy("depth", "ha", "hb").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.sum("length").alias("lengths"), F.max("length").alias("longest"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    )
    nodes = nodes.withColumn("weight", F.col("lengths") - F.col("n_convs") * (F.col("depth") - 1))
    nodes = saved(nodes.withColumn("leaf", F.col("longest") == F.col("depth")), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ha").alias("pa"), F.col("hb").alias("pb"), F.col("rep").alias("up"))
    first = nodes.where("depth = 1").withColumn("up", F.lit(least).cast("long"))
    nodes = saved(nodes.where("depth > 1").join(above, ["depth", "pa", "pb"]).unionByName(first), "parents")
    keys = nodes.select("depth", "ha", "hb", "rep", "up")
    ways = rows.select("id", "depth", "ha", "hb", (F.col("depth") == F.col("length")).alias("last")).join(keys, ["depth", "ha", "hb"])
    top = conversations.select(
        "id", F.lit(0).cast("long").alias("depth"), F.lit(least).cast("long").alias("rep"), F.lit(None).cast("long").alias("up"),
        (F.col("length") == 0).alias("last"),
    )
    ways = saved(ways.select("id", "depth", "rep", "up", "last").unionByName(top), "ways")
    nodes = nodes.select("rep", "depth", "up", "n_convs", "words", "weight", "leaf")
    if least is None:
        return nodes, ways
    top = nodes.sparkSession.createDataFrame([(least, 0, None, many, 0, weight, longest == 0)], nodes.schema)
    return nodes.unionByName(top), ways


def at_component(rows: DataFrame, found: DataFrame, whole: int) -> DataFrame:
    """`rows` with the columns of `found` for their component (`top`, `top_depth`). Large components are
    fewer than LARGE rows and are broadcast; the others are joined by sorting, where no key is hot."""
    key = ["top", "top_depth"]
    large = found.where(F.col("total") * LARGE > whole)
    small = found.where(F.col("total") * LARGE <= whole)
    others = rows.join(F.broadcast(large.select(key)), key, "left_anti")
    return rows.join(F.broadcast(large), key).unionByName(others.join(small.hint("merge"), key))


def within(columns: list[np.ndarray], values: list[np.ndarray]) -> list[np.ndarray]:
    """Sums over subtrees for whole components in one block: the same rounds as `rolled_up`, in arrays.

    `columns` are top, top_depth, rep, depth, parent and weight. A node is below another if its place in
    preorder lies among that one's subtree, which replaces the look at the way to it."""
    top, top_depth, rep, depth, parent, weight = columns
    n = len(rep)
    names, code = np.unique(np.concatenate([rep, parent]), return_inverse=True)
    levels, level = np.unique(depth, return_inverse=True)
    is_top = (rep == top) & (depth == top_depth)
    key = code[:n] * len(levels) + level
    by_key = np.argsort(key)
    above = by_key[np.minimum(np.searchsorted(key[by_key], code[n:] * len(levels) + level - 1), n - 1)]
    above = np.where(is_top, n, above)  # place n stands above all tops
    size = np.ones(n + 1, np.int64)
    by_level = np.split(np.argsort(level, kind="stable"), np.cumsum(np.bincount(level))[:-1])
    for nodes in reversed(by_level):
        np.add.at(size, above[nodes], size[nodes])
    kin = np.argsort(above, kind="stable")
    before = np.cumsum(size[kin]) - size[kin]
    starts = np.flatnonzero(np.diff(above[kin], prepend=-1))
    place = np.zeros(n + 1, np.int64)
    place[kin] = before - np.repeat(before[starts], np.diff(np.append(starts, n))) + 1
    for nodes in by_level:
        place[nodes] += place[above[nodes]]
    # Tops come first among the nodes of their component, by depth.
    component = np.flatnonzero(is_top)[np.cumsum(is_top) - 1]
    weight, sums, result = weight.copy(), [np.zeros(n, np.int64) for _ in values], [np.zeros(n, np.int64) for _ in values]
    mid = np.empty(n, np.int64)
    left = np.arange(n)
    while len(left):
        order = left[np.lexsort((weight[left], -np.frexp(weight[left].astype(float))[1], component[left]))]
        mids = order[np.flatnonzero(np.diff(component[order], prepend=-1))]
        mid[component[mids]] = mids
        own = mid[component[left]]
        inside = (place[left] >= place[own]) & (place[left] < place[own] + size[own])
        over = (place[left] < place[own]) & (place[own] < place[left] + size[left])
        for value, total, out in zip(values, sums, result):
            below = np.zeros(n, np.int64)
            np.add.at(below, own[inside], value[left[inside]])
            out[mids] = below[mids] + total[mids]
            total[left[over]] += below[own[over]]
        weight[left[over]] -= weight[own[over]]
        stay = left != own
        deep, centre = left[inside & stay], own[inside & stay]
        kids = deep[above[deep] == centre]
        spot = component[kids] * (n + 1) + place[kids]
        kids, spot = kids[np.argsort(spot)], np.sort(spot)
        component[deep] = kids[np.searchsorted(spot, component[deep] * (n + 1) + place[deep], "right") - 1]
        left = left[stay]
    return result


def finished(rows: DataFrame, values: list[str]) -> DataFrame:
    """(`rep`, `depth` and the values) of small components: every one meets in one task, as rows in order, and is
    decomposed there together with its neighbours in the block. `sum_` columns are what was added before."""
    sums = [f"sum_{v}" for v in values]
    key = ["top", "top_depth"]
    rows = rows.select(*key, "rep", "depth", F.coalesce("parent", "rep").alias("parent"), "weight", *values, *sums)
    rows = rows.repartition(*key).sortWithinPartitions(*key, "depth", "rep")

    def solved(table: pa.Table) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in table.columns]
        given, added = columns[6:6 + len(values)], columns[6 + len(values):]
        totals = [t + a for t, a in zip(within(columns[:6], given), added)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (columns[2], columns[3], *totals)], names=["rep", "depth", *values])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            top, top_depth = (table.column(c).to_numpy() for c in key)
            cut = int(np.flatnonzero((top != top[-1]) | (top_depth != top_depth[-1]))[-1:].sum()) + 1
            if top[cut - 1] == top[-1] and top_depth[cut - 1] == top_depth[-1]:
                continue  # one component so far
            yield solved(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if sum(b.num_rows for b in held):
            yield solved(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(blocks, ", ".join(f"{c} long" for c in ("rep", "depth", *values)))


def rolled_up(nodes: DataFrame, ways: DataFrame, values: list[str], small: int) -> DataFrame:
    """(`rep`, `depth` and the values) with each value summed over the node's subtree.

    Centroid decomposition of the forest of parent edges. In every component the centroid is the lowest node
    whose weight has as many binary digits as the whole component's: there is exactly one, and of the parts
    that its removal leaves none has as many. So after at most as many rounds as the weight of all has digits
    (a path of a million nodes takes 20), each node has been a centroid. A round, for all components at once:

    1. One aggregation finds the centroids, and every node learns its component's.
    2. A node is below the centroid if the centroid is on the way to the node's smallest member; the node
       after it on that way is the top of the node's new component.
    3. The values below and at the centroid add up to the component's total for it.
    4. That total is added to all nodes on the way from the centroid to its component's top. These lose its
       weight and stay together as the remaining component.

    A node's sum is its total as a centroid and what was added to it before. A component whose weight is at most
    `small` leaves the rounds: its further rounds need nothing from outside, so one task goes through them.
    """
    sums = [f"sum_{v}" for v in values]
    columns = ["rep", "depth", "parent", "weight", *values, *sums, "top", "top_depth"]
    top = nodes.where("depth = 0").select("rep", "weight").first()
    if top is None:
        return nodes.select("rep", "depth", *values)
    whole = top["weight"]
    state = nodes.withColumns({
        "parent": F.col("up"), "top": F.lit(top["rep"]).cast("long"), "top_depth": F.lit(0).cast("long"),
        **{s: F.lit(0).cast("long") for s in sums},
    })
    state = saved(state.select(*columns), "forest")
    done: list[DataFrame] = []
    leaving: list[DataFrame] = []
    ahead = ways.select(F.col("id").alias("rep"), F.col("depth").alias("next_depth"), F.col("rep").alias("next"), "up")
    while True:
        digits = F.length(F.bin("weight"))
        best = F.max(F.struct(digits.alias("digits"), (-F.col("weight")).alias("weight"), "rep", "depth"))
        found = state.groupBy("top", "top_depth").agg(best.alias("best"), F.max("weight").alias("total"))
        found = saved(found.select(
            "top", "top_depth", "total", F.col("best.rep").alias("mid"), F.col("best.depth").alias("mid_depth"),
            (-F.col("best.weight")).alias("mid_weight"),
        ), "centroids")
        if not found.where(F.col("total") > small).limit(1).count():
            leaving.append(state)
            break
        met = at_component(state, found, whole).withColumn("next_depth", F.col("mid_depth") + 1)
        deep = F.expr("depth > mid_depth") & (F.col("total") > small)
        rest = met.where(~deep).withColumns({c: F.lit(None).cast("long") for c in ("next", "up")})
        met = met.where(deep).join(ahead.hint("merge"), ["rep", "next_depth"]).unionByName(rest)
        met = met.withColumn("below", F.coalesce(F.col("up") == F.col("mid"), F.lit(False)))
        met = saved(met.withColumn("is_mid", (F.col("rep") == F.col("mid")) & (F.col("depth") == F.col("mid_depth"))), "met")
        leaving.append(met.where(F.col("total") <= small).select(*columns))
        met = met.where(F.col("total") > small)
        totals = met.where("below OR is_mid").groupBy("mid", "mid_depth", "mid_weight", "top_depth").agg(
            *[F.sum(v).alias(v) for v in values], *[F.sum(F.when(F.col("is_mid"), F.col(s))).alias(s) for s in sums]
        )
        totals = saved(totals, "totals")
        done.append(totals.select(
            F.col("mid").alias("rep"), F.col("mid_depth").alias("depth"), *[(F.col(v) + F.col(s)).alias(v) for v, s in zip(values, sums)]
        ))
        up = totals.where("mid_depth > top_depth").select(
            F.col("mid").alias("id"), "mid_depth", "top_depth", F.col("mid_weight").alias("loss"), *[F.col(v).alias(f"more_{v}") for v in values]
        )
        path = ways.join(up.hint("merge"), "id").where("depth >= top_depth AND depth < mid_depth")
        path = path.select("rep", "depth", "loss", *[f"more_{v}" for v in values])
        left = met.where("NOT is_mid").join(path.hint("merge"), ["rep", "depth"], "left")

        def more(base: str, by: Column) -> Column:
            return (F.col(base) + F.coalesce(by, F.lit(0))).alias(base)

        state = saved(left.select(
            "rep", "depth", "parent", more("weight", -F.col("loss")), *values, *[more(s, F.col(f"more_{v}")) for s, v in zip(sums, values)],
            F.when(F.col("below"), F.col("next")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("below"), F.col("next_depth")).otherwise(F.col("top_depth")).alias("top_depth"),
        ), "forest")
    return reduce(DataFrame.unionByName, [finished(reduce(DataFrame.unionByName, leaving), values), *done])


def ends(ways: DataFrame) -> DataFrame:
    """(`rep`, `depth`, `ends_sha256`) of the nodes where conversations end: the digest of their ids in order.

    Ids are dealt by ranges and written in runs, so a node with very many is many rows in many tasks. Only the
    digest itself, which can't be split, reads the runs one after the other, and holds one at a time."""
    last = saved(ways.where("last").select("rep", "depth", "id"), "last")
    last = last.repartitionByRange("rep", "depth", "id").sortWithinPartitions("rep", "depth", "id")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, depth, ids = (c.to_numpy() for c in batch.columns)
            new = np.flatnonzero((np.diff(rep) != 0) | (np.diff(depth) != 0)) + 1
            starts = [s for a, b in zip([0, *new.tolist()], [*new.tolist(), len(ids)]) for s in range(a, b, RUN)]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, [*starts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[starts]) for x in (rep, depth, ids)] + [pa.array(texts, pa.string())], names=["rep", "depth", "id", "text"]
            )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = {"rep": pa.int64(), "depth": pa.int64(), "ends_sha256": pa.string()}
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds.values())], names=list(kinds))

        now, digest = None, None
        for batch in batches:
            found = []
            for rep, depth, text in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "text"))):
                if now == (rep, depth):
                    digest.update(b"," + text.encode())
                    continue
                if now is not None:
                    found.append((*now, digest.hexdigest()))
                now, digest = (rep, depth), hashlib.sha256(text.encode())
            if found:
                yield rows(found)
        if now is not None:
            yield rows([(*now, digest.hexdigest())])

    runs = last.mapInArrow(written, "rep long, depth long, id long, text string")
    runs = runs.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "id")
    return runs.mapInArrow(digested, "rep long, depth long, ends_sha256 string")


def summary(
    conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per node of the trie: `conv_id` (its smallest member), `depth`, `parent_conv_id`, `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens` and `ends_sha256`.

    Conversations are ordered by turn, nulls first; turns under one number by hashes of what is said, so the
    order of the rows doesn't matter, and repeated rows are turns of their own. A null role or text is empty.
    Rows without a conversation's id belong to none. Conversation c is rebuilt from the first crc32(c) % SHARED
    turns of c - c % FAMILY and its own turns after as many. One without any turn is a member of the root alone.
    An empty table gives an empty result; other columns don't matter. Ids are 64-bit numbers.
    """
    turns, all_of_them = rebuilt(conversations, id, turn, role, text)
    nodes, ways = trie(turns, all_of_them)
    value = nodes.withColumn("n_leaves", F.col("leaf").cast("long"))
    value = saved(value.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")), "trie")
    sums = rolled_up(value, ways, ["n_leaves", "saved_tokens"], SMALL)
    children = value.where("depth > 0").groupBy(F.col("up").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    key = ["rep", "depth"]
    every = value.select(*key, "up", "n_convs").join(sums, key).join(children, key, "left").join(ends(ways), key, "left")
    return every.select(
        F.col("rep").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
