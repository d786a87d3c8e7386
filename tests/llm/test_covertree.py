"""Vector codes against plain Lloyd rounds over all rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from quaylake.llm import covertree, queries

COLUMNS = "vec_id long, embedding array<float>, label int, id string, code int, LABEL_error string"


def rows(n: int = 400, dims: int = 16) -> list[tuple]:
    rng = np.random.default_rng(5)
    centers = rng.normal(0, 1, (20, dims))
    found = []
    for i in range(n):
        v = (centers[i % 20] + rng.normal(0, 0.05, dims)).astype(np.float32).tolist()
        found.append((i, v, i % 3 if i % 7 else None))
    found += [found[3], found[3], (None, found[5][1], 1), (n + 1, None, 2), (n + 2, [], 2)]
    for bad in (None, math.nan, math.inf, -math.inf):
        found.append((-1, [bad] + found[0][1][1:], 1))
    found += [(n + 10 + i, [0.0] * dims, 9) for i in range(120)]  # many equal vectors
    return [(*r, "x", 1, "y") for r in found]


def brute(found: list[tuple]) -> set[tuple]:
    kept = [r for r in found if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return set()
    points = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    d = len(points[0]) // 8
    parts = [[p[k * d:(k + 1) * d] for p in points] for k in range(8)]
    books = [part[:16] for part in parts]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min((far(p, e), j) for j, e in enumerate(book)) for p in part] for part, book in zip(parts, books)]

    for _ in range(6):
        for k, near in enumerate(assigned()):
            for j in range(len(books[k])):
                mine = [p for p, (_, e) in zip(parts[k], near) if e == j]
                if mine:
                    books[k] = books[k][:j] + [[sum(c) // len(mine) for c in zip(*mine)]] + books[k][j + 1:]
    near = assigned()
    errors = [sum(near[k][i][0] for k in range(8)) for i in range(len(kept))]
    labels: dict = {}
    for r, e in zip(kept, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        repr((r[0], "".join(f"{near[k][i][1]:02x}" for k in range(8)), errors[i], labels[r[2]], digest)) for i, r in enumerate(kept)
    )


def test_trees_hold_what_they_promise():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-50, 50, (700, 3)), np.zeros((40, 3), np.int64)])
    tree = covertree.Tree.over(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for center, radius, (begin, end, child, many) in zip(tree.center, tree.radius, tree.span):
        assert (covertree.squared(tree.points[begin:end], center[None])[:, 0] <= radius ** 2).all()
        if many:
            spans = tree.span[child:child + many]
            assert spans[0, 0] == begin and spans[-1, 1] == end and (spans[1:, 0] == spans[:-1, 1]).all()
            apart = covertree.squared(tree.center[child:child + many], tree.center[child:child + many])
            assert 4 * apart[~np.eye(many, dtype=bool)].min() > (radius / (1 + covertree.ROUNDING)) ** 2 * (1 - 1e-9)
    for k in (1, 2, 16):
        entries = points[rng.integers(0, len(points), k)]  # with ties and equal entries
        label, sums, counts = tree.assigned(entries)
        best = covertree.squared(points, entries).argmin(axis=1)
        assert (label == best).all() and (np.bincount(best, minlength=k) == counts).all()
        assert all((sums[j] == points[best == j].sum(axis=0)).all() for j in range(k))
        again = covertree.Tree.unpacked(points, tree.packed())
        assert (again.assigned(entries)[0] == best).all()


def test_whole_subtrees_are_assigned():
    """On clustered points far fewer distances are taken than points times entries."""
    rng = np.random.default_rng(2)
    centers = rng.integers(-100_000, 100_000, (16, 8))
    points = np.repeat(centers, 200, axis=0) + rng.integers(-50, 50, (3200, 8))
    tree, taken = covertree.Tree.over(points), []
    plain = covertree.squared
    covertree.squared = lambda p, e: taken.append(len(p)) or plain(p, e)
    try:
        tree.assigned(centers)
    finally:
        covertree.squared = plain
    assert sum(taken) < 200


@pytest.mark.parametrize("chunk", [64, 2048])
def test_the_query_against_plain_rounds(session, tmp_path, chunk, monkeypatch):
    monkeypatch.setattr(covertree, "CHUNK", chunk)
    session.createDataFrame(rows(), COLUMNS).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op11_vector_codes"](session, str(tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(rows())


def test_few_rows_and_none(session):
    few = rows()[:5]
    found = covertree.compressed(session.createDataFrame(few, COLUMNS))
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(few)
    nothing = covertree.compressed(session.createDataFrame([(1, None, 1, "x", 1, "y")], COLUMNS))
    assert nothing.collect() == [] and nothing.columns == found.columns
    assert covertree.compressed(session.createDataFrame([], COLUMNS)).count() == 0


def test_vectors_that_have_no_codes(session):
    with pytest.raises(ValueError):
        covertree.compressed(session.createDataFrame([(1, [1.0] * 9, 1, "x", 1, "y")], COLUMNS))
    with pytest.raises(ValueError):
        covertree.compressed(session.createDataFrame([(1, [1e9] * 8, 1, "x", 1, "y")], COLUMNS))
