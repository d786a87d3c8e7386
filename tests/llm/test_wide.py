"""Wide SimHash fingerprints: what they are, where they meet, and that the pipeline's near duplicates go through them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

import corpus_pipeline
from quaylake.llm import minhash, simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def packed(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    found = [simhash.wide(s) for s in sets]
    return tuple(pa.array([f[i].tobytes() for f in found], pa.binary()) for i in (0, 1))


def alike_sets(rng, size: int, nested: bool) -> tuple[np.ndarray, np.ndarray]:
    """Two sets of similarity 0.8 or little more: one within the other, or of one size."""
    apart = size // 5 if nested else size // 9
    both = rng.integers(0, 1 << 63, size if nested else size + apart, np.uint64)
    return (both, both[apart:]) if nested else (both[:size], both[apart:])


def mixed(x: int) -> int:
    """One step of SplitMix64."""
    full = (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
    x = (x ^ x >> 27) * 0x94D049BB133111EB & full
    return x ^ x >> 31


def test_bits_are_majorities_and_loose_ones_the_closest():
    rng = np.random.default_rng(1)
    for size in (1, 2, 9, 600):
        found = rng.integers(0, 1 << 63, size, np.uint64)
        value, loose = simhash.wide(found)
        for part in (0, 1, 36, simhash.PARTS - 1):
            step = 0x9E3779B97F4A7C15 * (part // 2 + 1)
            words = [mixed(int(x) + step & (1 << 64) - 1) >> 32 * (part % 2) for x in found]
            lead = [2 * sum(w >> b & 1 for w in words) - size for b in range(simhash.WIDTH)]
            assert int(value[part]) == sum(1 << b for b, x in enumerate(lead) if x > 0)
            nearest = sorted(range(simhash.WIDTH), key=lambda b: (abs(lead[b]), b))[:simhash.LOOSE]
            assert sorted(loose[part].tolist()) == sorted(nearest)


def test_fingerprints_meet_where_only_loose_bits_differ():
    rng = np.random.default_rng(2)
    sets = [s for _ in range(10) for s in alike_sets(rng, 60, True)]
    prints, loose = packed(sets)
    got = simhash.probes(10, 20).func(pa.array([*prints.to_pylist(), b""], pa.binary()), pa.array([*loose.to_pylist(), b""], pa.binary())).to_pylist()
    assert got.pop() == [] and {len(set(g)) for g in got} == {10 << simhash.LOOSE}
    found = [simhash.wide(s) for s in sets]
    for i, (x, p) in enumerate(found):
        for j, (y, q) in enumerate(found):
            free = [sum({1 << int(b) for b in [*p[k], *q[k]]}) for k in range(10, 20)]
            expected = {k for k, f in zip(range(10, 20), free) if not (int(x[k]) ^ int(y[k])) & ~f}
            assert {v >> simhash.WIDTH for v in set(got[i]) & set(got[j])} == expected


def test_sets_of_similarity_080_meet_and_are_close():
    rng = np.random.default_rng(3)
    for size in (66, 120, 400):
        for nested in (False, True):
            pairs = [alike_sets(rng, size, nested) for _ in range(150)]
            left, right = (packed([p[i] for p in pairs]) for i in (0, 1))
            one, two = (simhash.probes(0, simhash.PARTS).func(*side).to_pylist() for side in (left, right))
            assert all(set(x) & set(y) for x, y in zip(one, two))
            assert all(simhash.close.func(left[0], right[0]).to_pylist())
    strange = packed([rng.integers(0, 1 << 63, 200, np.uint64) for _ in range(300)])[0]
    assert not any(simhash.close.func(strange.slice(0, 150), strange.slice(150)).to_pylist())


def test_short_sets_meet_under_their_first_shingles():
    rng = np.random.default_rng(4)
    for size in range(4, minhash.SHORT + 1):
        for nested in (False, True):
            x, y = (np.sort(s) for s in alike_sets(rng, size, nested))
            assert set(minhash.leading(x).tolist()) & set(minhash.leading(y).tolist())
    assert len(minhash.leading(np.arange(minhash.SHORT + 1, dtype=np.uint64))) == 0


def test_near_copies_of_the_stage_meet_in_segments(session, tmp_path, monkeypatch):
    """Without the segments nothing proposes long texts, so no other way stands beside them."""
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base), " ".join([*base[:150], "x", *base[151:]]), " ".join(base[::-1])]
    docs = session.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS)

    def kept() -> list[int]:
        return sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(session, docs, str(tmp_path)).collect())

    assert kept() == [0, 2]
    monkeypatch.setattr(minhash, "met_in_segments", lambda sets: minhash.together(sets.selectExpr("node", "n", "explode(least) AS key")))
    assert kept() == [0, 1, 2]
