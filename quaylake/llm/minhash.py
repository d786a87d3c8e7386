"""Near duplicates by the similarity of shingle sets: the segments of wide SimHash fingerprints propose pairs, as in
multi-index hashing, their whole distance sorts out chance meetings, and the sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from quaylake.llm import simhash
from quaylake.llm.common import components, numbered, position, saved
from quaylake.llm.substring import FIRST, rolled

SHINGLE = 5
LEAST = (4, 5)  # the least similarity as a fraction
SEED = 42
SHORT = 64  # sets of so few shingles, whose fingerprints have few votes, also meet under their first shingles
AT_ONCE = 18  # segments probed at a time: the shuffle files of one turn go before the next
SMALL = 32  # members of a bucket that may be compared with one
TWICE = 2  # segments in which a member of a crowd meets its pivot, if in no crowded bucket
LEFT = 16  # pairs per member of the first buckets up to which what is left of crowds is compared at once
RARE = 64  # a shingle in which one of so many members of a crowd differs from its pivot is common
# Sets x and y have the least similarity if REACH times the number of shingles only one has is at most |x| + |y|.
REACH = (LEAST[1] + LEAST[0]) // (LEAST[1] - LEAST[0])

SKETCH = StructType([
    StructField("a", LongType()), StructField("b", LongType()), StructField("n", LongType()),
    StructField("print", BinaryType()), StructField("loose", BinaryType()), StructField("least", ArrayType(LongType())),
])


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text in UTF-8: ASCII letters lowered, `width` words
    each; fewer words are one shingle, none has none."""
    words = np.array([xxhash.xxh64_intdigest(w, SEED) for w in text.lower().split()], np.uint64)
    return np.unique(rolled(words, min(width, len(words)), FIRST)) if len(words) else words


def leading(found: np.ndarray) -> np.ndarray:
    """The smallest shingles of a set, as many as hold one of any set like it (all but the least similarity's
    share, and one), marked off from the segments' values by their sign."""
    n = len(found) if len(found) <= SHORT else 0
    return found[:n - -(-LEAST[0] * n // LEAST[1]) + 1 if n else 0] | np.uint64(1 << 63)


@F.arrow_udf(SKETCH)
def sketches(text: pa.Array) -> pa.Array:
    """Two hashes of the whole set, its size, its wide fingerprint with the loose places and its leading shingles."""
    sets = [shingles(t or b"") for t in text.to_pylist()]
    whole = [[xxhash.xxh64_intdigest(s.tobytes(), seed) for s in sets] for seed in (SEED, SEED + 1)]
    prints = [simhash.wide(s) if len(s) else (np.zeros(0), np.zeros(0)) for s in sets]
    least = [leading(s) for s in sets]
    ends = np.cumsum([0, *(len(x) for x in least)])
    return pa.StructArray.from_arrays(
        [*(pa.array(np.array(w, np.uint64).view(np.int64)) for w in whole), pa.array([len(s) for s in sets], pa.int64()),
         *(pa.array([p[i].tobytes() for p in prints], pa.binary()) for i in (0, 1)),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *least]).view(np.int64)))],
        names=SKETCH.names,
    )


@F.arrow_udf(BinaryType())
def packed_shingles(text: pa.Array) -> pa.Array:
    return pa.array([shingles(t or b"").tobytes() for t in text.to_pylist()], pa.binary())


@F.arrow_udf(BooleanType())
def alike(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two sets have the least similarity: shared shingles over all shingles."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        shared = len(np.intersect1d(left, right, assume_unique=True))
        out.append(LEAST[1] * shared >= LEAST[0] * (len(left) + len(right) - shared))
    return pa.array(out, pa.bool_())


def near_sizes(n: Column, m: Column) -> Column:
    """Sets of these sizes can have the least similarity."""
    return LEAST[1] * F.least(n, m) >= LEAST[0] * F.greatest(n, m)


def difference(x: bytes, pivot: bytes) -> np.ndarray:
    """The shingles that only one of two sets has."""
    return np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(pivot, np.uint64), assume_unique=True).view(np.int64)


def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles in which many sets of a batch differ from their pivot, with the number of these sets."""
    for batch in batches:
        found: dict[int, list[np.ndarray]] = {}
        for a, right, left in zip(*(batch.column(c).to_pylist() for c in ("a", "right", "left"))):
            found.setdefault(a, []).append(difference(right, left))
        rows = []
        for a, sets in found.items():
            element, count = np.unique(np.concatenate(sets), return_counts=True)
            often = count >= max(2, len(sets) / RARE)
            rows += [(a, e, n) for e, n in zip(element[often].tolist(), count[often].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["a", "element", "count"])


@F.arrow_udf(ArrayType(StructType([StructField("element", LongType()), StructField("small", BooleanType()), StructField("large", BooleanType())])))
def differences(node: pa.Array, pivot: pa.Array, common: pa.Array) -> pa.Array:
    """The shingles in which a set differs from its pivot, as far as a set like it must share one of them.

    With d differences of x from the pivot p, sets x and y are alike if they share at least
    (d_x + d_y - (|x| + |y|) / REACH) / 2 of them. Two that are both alike to p are linked by it; for any
    other pair that is one at least. Order the pair by d - |x| / REACH. Then the number it must share is bounded
    from one set alone, for the smaller and for the larger one of a pair, and by the prefix rule the first
    d - bound + 1 of both hold a shared one, in any order that all sets round p have in common. Here the
    `common` shingles come last, in their order, so that sets seldom meet without being alike.
    """
    out = []
    for x, p, last in zip(node.to_pylist(), pivot.to_pylist(), common.to_pylist()):
        found, often = difference(x, p), np.array(last or [], np.int64)
        n, m, d = len(x) // 8, len(p) // 8, len(found)
        order = np.concatenate([np.setdiff1d(found, often, assume_unique=True), often[np.isin(often, found)]])
        near = REACH * d <= n + m
        smaller = (REACH * d - n + m) // (2 * REACH) + 1 if near else -((n - REACH * d) // REACH)
        larger = d + 1 if near else max(1, -((n + m - REACH * d) // (REACH + 1)))
        small, large = max(0, d - smaller + 1), d - larger + 1
        out.append([{"element": e, "small": i < small, "large": i < large} for i, e in enumerate(order[:max(small, large)].tolist())])
    return pa.array(out, pa.list_(pa.struct([("element", pa.int64()), ("small", pa.bool_()), ("large", pa.bool_())])))


def with_sets(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) of rows of `texts` (row, text) with their sets `left` and `right`. Each set of `a` is
    moved once, whatever the number of its pairs."""
    nodes = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    sets = texts.join(nodes.hint("merge"), "row", "left_semi")
    sets = saved(sets.select("row", packed_shingles(F.col("text").cast("binary")).alias("found")), "sets")
    one = sets.select(F.col("row").alias("a"), F.col("found").alias("left"))
    two = sets.select(F.col("row").alias("b"), F.col("found").alias("right"))
    return pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that have the least similarity."""
    return saved(with_sets(pairs, texts).where(alike("left", "right")).select("a", "b"), "alike")


def together(keys: DataFrame) -> DataFrame:
    """Members of buckets (`node`, `n`, `key`) that are not alone, with the size of their bucket."""
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return saved(keys.join(sizes.hint("merge"), "key"), "met")


def met_in_segments(sets: DataFrame) -> DataFrame:
    """`together` for the values that the wide fingerprints probe in each segment and for the leading shingles."""
    met = together(sets.select("node", "n", F.explode("least").alias("key")))
    for low in range(0, simhash.PARTS, AT_ONCE):
        keys = simhash.probes(low, min(low + AT_ONCE, simhash.PARTS))(F.col("print"), F.col("loose"))
        met = met.unionByName(together(sets.select("node", "n", F.explode(keys).alias("key"))))
    return met


def closer(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose wide fingerprints are not too far apart, or that are both short."""
    one = sets.select(F.col("node").alias("a"), F.col("print").alias("left"), F.col("n").alias("n"))
    two = sets.select(F.col("node").alias("b"), F.col("print").alias("right"), F.col("n").alias("m"))
    both = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").withColumn("close", simhash.close("left", "right"))
    return both.where(F.col("close") | (F.greatest("n", "m") <= SHORT)).select("a", "b")


def pivoted(met: DataFrame) -> DataFrame:
    """Members of buckets (`node`, `n`, `key`, `members`) with the pivot (`low`) of their bucket, the member that
    meets most others (`score`) in all its buckets, the smallest one of several. So the buckets of one group have
    few pivots, and these stand in its middle."""
    score = met.groupBy("node").agg(F.sum("members").alias("score"))
    ranked = met.join(score.hint("merge"), "node")
    low = ranked.groupBy("key").agg(F.max(F.struct("score", (-F.col("node")).alias("node"))).alias("best"))
    low = low.select("key", (-F.col("best.node")).alias("low"), "best.score")
    return saved(met.join(low.hint("merge"), "key"), "pivoted")


def unlike(a: str, b: str) -> Column:
    """Members of different components whose sizes allow the least similarity."""
    return (F.col(f"{a}.root") != F.col(f"{b}.root")) & near_sizes(F.col(f"{a}.n"), F.col(f"{b}.n"))


def several(named: DataFrame, *columns: str) -> DataFrame:
    """Members of the buckets in which each of the columns has more than one value."""
    ends = [e for c in columns for e in (F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"))]
    keys = named.groupBy("key").agg(*ends).where(" AND ".join(f"{c}_low < {c}_high" for c in columns))
    return named.join(keys.select("key").hint("merge"), "key", "left_semi")


def placed(roots: DataFrame, crowd: DataFrame) -> DataFrame:
    """(`node`, `root`, `a`): the component of each node and the pivot of its crowd, null if it has none. A pivot is
    in its own crowd, because all others there are compared with it."""
    inside = crowd.select("node", "a").union(crowd.select(F.col("a").alias("node"), "a").distinct())
    return saved(roots.join(inside.hint("merge"), "node", "full"), "places")


def crowds(met: DataFrame, roots: DataFrame) -> DataFrame:
    """(`node`, `n`, `root`, `a`) of the members of crowds. Members that meet a pivot in a crowded bucket, or in
    TWICE segments whatever the size of their buckets (few do so by chance), are a crowd if they are more than
    SMALL and of several components. Crowds with a common member are one, and its pivot `a` is the one of most of
    its members. That one itself is left out."""
    pairs = met.groupBy("low", "node").agg(
        F.min("n").alias("n"), F.max("members").alias("members"),
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {simhash.WIDTH}) % 64 AS int))")).alias("places"),
    ).where((F.col("members") > SMALL) | (F.bit_count("places") >= TWICE))
    pairs = pairs.join(roots.hint("merge"), "node", "left")
    pairs = saved(pairs.select("low", "node", "n", F.coalesce("root", "node").alias("root")), "around")
    wide = pairs.groupBy("low").agg(F.count(F.lit(1)).alias("many"), F.min("root").alias("x"), F.max("root").alias("y"))
    wide = saved(wide.where((F.col("many") > SMALL) & (F.col("x") < F.col("y"))).select("low"), "wide")
    pairs = saved(pairs.join(wide.hint("merge"), "low", "left_semi"), "crowded")
    many = pairs.groupBy("low").agg(F.count(F.lit(1)).alias("many"))
    crowd = components(pairs.select(F.col("low").alias("a"), F.col("node").alias("b")))
    pivot = many.join(crowd, F.col("low") == F.col("node")).groupBy(F.col("root").alias("crowd"))
    pivot = pivot.agg(F.max(F.struct("many", (-F.col("low")).alias("low"))).alias("best")).select("crowd", (-F.col("best.low")).alias("a"))
    member = crowd.select("node", F.col("root").alias("crowd")).join(pivot.hint("merge"), "crowd").where("node <> a")
    return saved(member.join(pairs.select("node", "n", "root").distinct().hint("merge"), "node").select("node", "n", "root", "a"), "crowds")


def dealt(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """Members of a crowd by the shingles in which they differ from its pivot: (`node`, `n`, `root`, `small`,
    `large`, `key`) and how many may be the smaller and the larger one of a pair there. Any two members that
    can still be alike meet under a key."""
    both = saved(with_sets(crowd.withColumnRenamed("node", "b"), texts), "both")
    often = both.select("a", "right", "left").mapInArrow(frequent, "a long, element long, count long")
    often = often.groupBy("a", "element").agg(F.sum("count").alias("count"))
    often = often.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("count", "element"))).alias("common"))
    often = saved(often, "often")  # so that the join below can split a pivot with many members
    both = both.join(often.hint("merge"), "a", "left").withColumn("common", F.col("common.element"))
    each = both.select(F.col("b").alias("node"), "n", "root", "a", F.inline(differences("right", "left", "common")))
    each = saved(each.withColumn("key", F.xxhash64("a", "element")).drop("a", "element"), "dealt")
    useful = each.groupBy("key").agg(
        F.count_if("small").alias("smaller"), F.count_if("large").alias("larger"), F.min("root").alias("x"), F.max("root").alias("y")
    ).where("smaller > 0 AND larger > 0 AND x < y").select("key", "smaller", "larger")
    return saved(each.join(useful.hint("merge"), "key"), "useful")


def linked(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (node, root): components of the sets (`node`, `n`, `print`, `loose`, `least`), linked where the similarity
    of two that meet in a segment is large enough.

    Each set is compared with the best one of its buckets' pivots. Only buckets whose members are then in several
    components go on. Those with more than SMALL are crowds: their members are compared with the crowd's pivot
    and dealt to new buckets by the shingles in which they differ from it (`differences`); any two that can
    still be alike meet in one of these, one of them in the role of the smaller. New buckets with many of both
    roles start over, unless all their pairs are no more than LEFT times the members of the first buckets: few
    enough to be compared at once, however they are dealt. Everywhere else members of different components are
    compared with each other, at most SMALL for each; a small bucket goes on only if it has members of different
    crowds, or of none. So no group is paired, and no pair is lost.
    """
    met, links, start = pivoted(met_in_segments(sets)), None, True
    first = met.select("node").distinct().count()
    while True:
        best = met.groupBy("node").agg(F.max(F.struct("score", (-F.col("low")).alias("low"))).alias("best"))
        stars = best.select((-F.col("best.low")).alias("a"), F.col("node").alias("b")).where("a <> b")
        # Only values of segments meet by chance; what shares a difference from a pivot is compared in any case.
        found = verified(saved(closer(stars, sets) if start else stars, "stars"), texts)
        links = found if links is None else links.union(found)
        roots = components(links)
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # joins the same nodes, in stars
        crowd = crowds(met, roots)
        few = met.where(F.col("members") <= SMALL).join(placed(roots, crowd).hint("merge"), "node", "left")
        few = few.withColumns({"root": F.coalesce("root", "node"), "a": F.coalesce("a", -F.col("node") - 1)})
        few = saved(several(saved(few, "named"), "root", "a"), "few")  # pairs of one crowd meet there
        x, y = few.alias("x"), few.alias("y")
        apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.a") != F.col("y.a"))
        pairs = [x.join(y.hint("merge"), apart & unlike("x", "y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))]
        if start:
            pairs = [closer(saved(pairs[0].distinct(), "apart"), sets)]
        crowded = crowd.limit(1).count() > 0
        if crowded:
            pairs.append(crowd.select("a", F.col("node").alias("b")))
            useful = dealt(crowd, texts)
            many = F.least("smaller", "larger") > SMALL
            left = useful.agg(F.sum(F.when(F.col("small") & many, F.col("larger")))).first()[0] or 0
            again = left > LEFT * first
            direct = useful.where(~many) if again else useful
            x, y = direct.where("small").alias("x"), direct.where("large").alias("y")
            meet = (F.col("x.key") == F.col("y.key")) & unlike("x", "y")
            pair = x.join(y.hint("merge"), meet).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
            pairs.append(pair)
            keys = saved(useful.where(many & F.lit(again)).select("node", "n", "key").distinct(), "keys")
        every = pairs[0]
        for more in pairs[1:]:
            every = every.union(more)
        more = verified(saved(every.distinct(), "pairs"), texts)
        links = links.union(more)
        if not crowded or not keys.limit(1).count():
            return components(links) if more.limit(1).count() else roots
        met, start = pivoted(together(keys)), False


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keeps one document of each component of documents whose shingle sets have at least the similarity
    LEAST, the one with the smallest id; nulls come last and among equal ids one row stays. Columns are
    those of the input.

    Documents with equal sets (exact copies, null and empty texts) are one node before any comparison.
    """
    plain, body = numbered(docs), F.col(f"c{position(docs, text)}")
    key = F.col(f"c{position(docs, id)}")
    marked = plain.withColumn("row", F.monotonically_increasing_id()).withColumn("sketch", sketches(body.cast("binary")))
    marked = saved(marked, "sketches")
    order = [key.isNull().alias("none"), key.alias("id"), F.col("row")]
    first = F.min(F.struct(*order, *(F.col(f"sketch.{c}") for c in ("n", "print", "loose", "least"))))
    sets = saved(marked.groupBy("sketch.a", "sketch.b").agg(first.alias("first")).select("first.*"), "distinct")
    sets = sets.withColumnRenamed("row", "node")
    roots = linked(sets.select("node", "n", "print", "loose", "least"), marked.select("row", body.alias("text")))
    named = sets.select("none", "id", "node").join(roots.hint("merge"), "node", "left")
    kept = named.groupBy(F.coalesce("root", "node")).agg(F.min(F.struct("none", "id", "node")).alias("first"))
    kept = saved(kept.select(F.col("first.node").alias("row")), "kept")
    # Sorted on both sides whatever their size: texts are moved once either way at scale.
    return marked.join(kept.hint("merge"), "row", "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
