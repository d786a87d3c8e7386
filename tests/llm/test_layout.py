"""Shards, packed sequences, token pieces and nearest neighbours."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaylake.llm import packing, sharding, tokens, vptree


def test_matrix_has_the_margins_and_agrees_with_itself():
    for parts, n, shards, each in ((7, 1000, 4, 3), (1, 10, 3, 1), (13, 50, 16, 2), (5, 0, 16, 1)):
        counts = np.random.default_rng(1).multinomial(n, np.ones(parts) / parts)
        sizes = sharding.cell_sizes(n, shards, each)
        matrix = np.array([sharding.matrix_row(counts, sizes, i, 5) for i in range(parts)])
        assert (matrix.sum(axis=0) == sizes).all() and (matrix.sum(axis=1) == counts).all()
        shares = sizes.reshape(shards, each).sum(axis=1)
        assert shares.sum() == n and shares.max() - shares.min() <= 1


def test_large_draws():
    rng = np.random.default_rng(0)
    small = np.array([sharding.drawn(rng, 300, 700, 100) for _ in range(20_000)])
    assert abs(small.mean() - 30) < 0.2 and abs(small.var() - 100 * 0.21 * 900 / 999) < 1
    large = np.array([sharding.drawn(rng, 3 * 10**9, 7 * 10**9, 10**9) for _ in range(300)])
    assert abs(large.mean() / 3e8 - 1) < 1e-4 and 0.8 < large.std() / math.sqrt(1e9 * 0.21 * 0.9) < 1.2
    assert sharding.drawn(rng, 0, 5, 3) == 0 and sharding.drawn(rng, 5, 0, 3) == 3
    dealt = sharding.dealt(rng, np.array([10**9, 2 * 10**9, 5]), 10**9)
    assert dealt.sum() == 10**9 and dealt[2] <= 5


def test_shards(awkward, rows, empty):
    out = sharding.sharded(awkward, 16)
    assert [c for c in out.columns if c in ("shard", "slot")] == ["shard", "slot"]
    got = out.collect()
    text = out.columns.index("text")
    assert Counter((r[0], r[text]) for r in got) == Counter((r[0], r[1]) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.sharded(empty).count() == 0
    assert sharding.sharded(awkward.limit(3)).count() == 3


def test_order_is_random_and_depends_on_the_seed(session):
    table = session.range(0, 3000, 1, 7)
    orders = []
    for seed in range(4):
        got = {r["id"]: r["shard"] * 1500 + r["slot"] for r in sharding.sharded(table, 2, seed).collect()}
        assert sorted(got.values()) == list(range(3000))
        orders.append([got[i] for i in range(3000)])
    orders.append(list(range(3000)))
    correlations = np.corrcoef(orders)[np.triu_indices(5, 1)]
    assert np.abs(correlations).max() < 0.1  # five standard deviations
    # Neighbours are torn apart, too.
    assert all(abs(np.corrcoef(o[1:], o[:-1])[0, 1]) < 0.1 for o in orders[:-1])


def check(plan: packing.Plan, counts: Counter, capacity: int) -> None:
    placed, spans = Counter(), defaultdict(list)
    for length, low, high, first, each, begin in plan.segments:
        for rank in range(low, high):
            placed[length] += 1
            start = begin + (rank - low) % each * length
            spans[first + (rank - low) // each].append((start, start + length))
    assert placed == counts and len(spans) == plan.sequences
    for span in spans.values():
        span.sort()
        assert span[0][0] == 0 and span[-1][1] <= capacity
        assert all(a[1] == b[0] for a, b in zip(span, span[1:]))


def fewest(items: list[int], capacity: int) -> int:
    best = len(items)

    def put(i: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                put(i + 1, bins)
                bins[k] -= items[i]
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return best


def test_plans_place_every_piece():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 30, 100, 2048])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 5, 50, 2000])))
        check(packing.planned(counts, capacity), counts, capacity)


def test_reduction_never_costs_a_sequence():
    """What is fixed and the fewest sequences for the rest are together the fewest for all."""
    rng = random.Random(4)
    for _ in range(300):
        capacity = rng.choice([8, 12, 20])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        plan = packing.Plan(capacity, Counter(items))
        plan.reduce()
        rest = list(plan.left.elements())
        assert plan.fixed + fewest(rest, capacity) == fewest(items, capacity)
        assert packing.planned(Counter(items), capacity).sequences <= fewest(items, capacity) + 1


def test_wrong_lengths_are_refused(session):
    for lengths in ([0], [11], [None]):
        items = session.createDataFrame([(x,) for x in lengths], "length long")
        with pytest.raises(ValueError):
            packing.packed(items, capacity=10)


def test_packed_pieces(awkward, rows, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY))
    want = Counter()
    for i, text, *_ in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            want[i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    cut = tokens.pieces(awkward, 2048).withColumn("sequence_ID", F.lit("clash"))
    got = packing.packed(cut).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in got) == want
    spans = defaultdict(list)
    for r in got:
        spans[r["sequence_id"]].append((r["offset"], r["offset"] + r["length"]))
    for span in spans.values():
        span.sort()
        assert span[0][0] == 0 and span[-1][1] <= 2048 and all(a[1] == b[0] for a, b in zip(span, span[1:]))
    total = sum(r["length"] for r in got)
    assert len(spans) <= math.ceil(total / 2048) + 1
    assert packing.packed(tokens.pieces(empty, 2048)).count() == 0


def test_words_are_encoded_as_by_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY))
    words = ["the", "The.", "THEM.,", "it's", "don't.", "é", "Éa", "a b", "x1y2", "...", ".a", "<|endoftext|>",
             "Straße", "İx", "ΣΑΣ", "日本", "a\x1cb", "q r", "", "''s", "1.000,5", "end.̸"]
    mine = tokens.encoder(tokens.VOCABULARY).words(words)
    for word, ids in zip(words, mine):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids, word


def vectors(seed: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, 6))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.2, 6)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(150)]  # one vector many times
    rows += [(600, None), (601, [0.0] * 6), (602, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (603, [float("nan")] + [1.0] * 5),
             (604, [float("inf")] + [1.0] * 5), (605, []), (606, [1.0, 2.0]), (607, [1.0, 2.5]), (None, rows[3][1]),
             (20, rows[20][1]), (20, rows[9][1])]
    return rows


def usable(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def exact(rows: list[tuple], k: int, query) -> list[tuple]:
    good = [(n, i, v) for n, (i, v) in enumerate(rows) if usable(v)]
    out = []
    for n, i, v in good:
        if i is None or not query(i):
            continue
        near = []
        for m, j, w in good:
            if m != n and len(w) == len(v):
                total = 0.0
                for a, b in zip(v, w):
                    total += (a - b) * (a - b)
                near.append((math.sqrt(total), j is None, j if j is not None else 0, j))
        out += [(i, rank + 1, x[3], x[0]) for rank, x in enumerate(sorted(near)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_nearest_is_exact_with_factor_one(session, shard_rows):
    rows = vectors()
    table = session.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, score string, shard int")
    got = vptree.nearest(table.repartition(3), F.col("id") % 20 == 0, 5, shard_rows=shard_rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == exact(rows, 5, lambda i: i % 20 == 0)


def test_few_candidates_and_empty_tables(session):
    table = session.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vptree.nearest(table, F.col("id") == 0).collect()] == [(0, 1, 1, 1.0)]
    assert vptree.nearest(table.limit(0), F.col("id") == 0).count() == 0
    assert vptree.nearest(table.limit(1), F.lit(True)).count() == 0


def test_a_larger_factor_prunes_more_and_finds_most():
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (3000, 8))
    tree = vptree.Tree(points, [(False, i, i) for i in range(len(points))], 10)
    queries = points[:200]
    sure, _ = tree.search(queries, 10, 1.0)
    want = np.sort(vptree.distances(queries, points), axis=1)[:, :10]
    assert (sure == want).all()
    loose, _ = tree.search(queries, 10, 1.5)
    assert 0.9 < (loose <= sure[:, -1:]).mean() <= 1
