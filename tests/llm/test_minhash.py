"""Near duplicates of the pipeline against all pairs compared."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from quaylake.llm import minhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text: str | None) -> frozenset[str]:
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def similarity(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def firsts(rows: list[tuple]) -> list:
    """Smallest id of each component, nulls last."""
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    groups: dict[int, list] = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append(r[0])
    return sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=repr)


def changed(words: list[str], places: list[int], mark: str) -> list[str]:
    return [f"{mark}{i}" if i in places else w for i, w in enumerate(words)]


def planted() -> list[tuple]:
    """Pairs of every similarity round the threshold, a chain and copies that differ a little each."""
    rng, texts = random.Random(5), []
    prose = lambda n: [f"w{rng.randrange(10_000)}" for _ in range(n)]
    for edits in range(1, 8):
        for _ in range(4):
            base = prose(200)
            texts += [base, changed(base, rng.sample(range(10, 190), edits), "x")]
    chain = prose(200)  # neighbours are alike, ends are not, and the middle one has the largest id
    texts += [changed(chain, [20, 50, 80], "a"), changed(chain, [110, 140, 170], "b"), chain]
    group = prose(300)
    texts += [changed(group, [rng.randrange(300)], f"g{k}_") for k in range(60)]
    texts += [["one"], ["one", "two"], ["ONE", "Two"], [], []]
    return [(i, " ".join(t), "en", f"s{i % 9}", 0) for i, t in enumerate(texts)]


def ids(df) -> list:
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr)


def test_stage_drops_near_copies_of_similarity_080_and_more(session, tmp_path):
    rows = planted()
    found = [similarity(shingles(a[1]), shingles(b[1])) for a, b in zip(rows[:56:2], rows[1:56:2])]
    assert sum(0.8 <= s < 0.9 for s in found) >= 3 and sum(0.6 < s < 0.8 for s in found) >= 3
    docs = session.createDataFrame(rows, COLUMNS).repartition(3)
    assert ids(corpus_pipeline.near_duplicates(session, docs, str(tmp_path))) == firsts(rows)


def test_awkward_documents(awkward, rows, empty):
    kept = minhash.one_of_each(awkward)
    assert kept.dtypes == awkward.dtypes and ids(kept) == firsts(rows)
    assert minhash.one_of_each(empty).count() == 0


def crowd(seed: int, members: int, edits: range, words: int = 150) -> list[tuple]:
    """Copies of one text that differ from it in several words, so that most pairs are just below 0.8, with
    copies of copies among them, and pairs of words left out and put in."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    texts = [base]
    for k in range(members):
        source = base if k % 5 else rng.choice(texts)
        text = changed(source, rng.sample(range(len(source)), rng.choice(edits)), f"m{k}_")
        if k % 7 == 0:
            at = rng.randrange(len(text) - 9)
            text = text[:at] + text[at + 4:] if k % 2 else text[:at] + [f"n{k}_{i}" for i in range(4)] + text[at:]
        texts.append(text)
    rng.shuffle(texts)
    return [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]


def compared(monkeypatch) -> list[int]:
    counts: list[int] = []
    plain = minhash.saved

    def counted(df, name):
        out = plain(df, name)
        if name in ("stars", "pairs"):
            counts.append(out.count())
        return out

    monkeypatch.setattr(minhash, "saved", counted)
    return counts


def test_a_crowd_below_the_threshold_is_not_paired(session, monkeypatch):
    rows = crowd(11, 400, range(2, 9))
    counts = compared(monkeypatch)
    kept = minhash.one_of_each(session.createDataFrame(rows, COLUMNS).repartition(3))
    assert ids(kept) == firsts(rows)
    assert 50 < len(firsts(rows)) < 390  # some are alike, most are not
    assert sum(counts) < 15 * len(rows)  # all pairs are 80,000


def test_members_of_one_crowd_leave_their_small_buckets(session, monkeypatch):
    """Copies of one text meet in many small buckets beside the crowded ones; no pair of a crowd is looked for there."""
    rows, sizes, plain = crowd(11, 400, range(2, 9)), {}, minhash.saved

    def counted(df, name):
        sizes.setdefault(name, []).append((out := plain(df, name)).count())
        return out

    monkeypatch.setattr(minhash, "saved", counted)
    kept = minhash.one_of_each(session.createDataFrame(rows, COLUMNS).repartition(3))
    assert ids(kept) == firsts(rows)
    assert sizes["crowds"][0] > 300 and sizes["few"][0] < 20 * len(rows)  # 43,100 by crowded buckets alone


@pytest.mark.parametrize("left", [0, 1])
def test_crowds_of_any_size_give_what_all_pairs_give(session, monkeypatch, left):
    monkeypatch.setattr(minhash, "SMALL", 4)  # nearly every group goes on by differences
    monkeypatch.setattr(minhash, "LEFT", left)  # to the end, or until few pairs are left
    rows = []
    for seed, edits in enumerate((range(1, 4), range(2, 7), range(3, 10))):
        rows += [(r[0] + 1000 * seed, *r[1:]) for r in crowd(seed, 40, edits, 80 + 40 * seed)]
    kept = minhash.one_of_each(session.createDataFrame(rows, COLUMNS).repartition(3))
    assert ids(kept) == firsts(rows)


def test_differences_meet_wherever_sets_are_alike():
    """Prefixes of any two sets that are alike, but not both to the pivot, share a shingle in the right roles."""
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randrange(20, 60)
        pivot = set(range(size))

        def near(source: set, k: int) -> set:
            out = set(source) - set(rng.sample(sorted(source), min(k, len(source) - 1)))
            return out | {rng.randrange(1000, 1100) for _ in range(rng.randrange(k + 2))}

        one = near(pivot, rng.randrange(0, 12))
        found = [one, *(near(rng.choice([one, pivot]), rng.randrange(0, 9)) for _ in range(8))]
        packed = pa.array([np.array(sorted(s), np.uint64).tobytes() for s in [*found, pivot]], pa.binary())
        common = pa.array([rng.sample(range(size), 9)] * len(packed), pa.list_(pa.int64()))
        got = minhash.differences.func(packed, pa.array([packed[-1].as_py()] * len(packed), pa.binary()), common).to_pylist()
        alike = lambda x, y: 5 * len(x & y) >= 4 * len(x | y)
        for i, x in enumerate(found):
            for j, y in enumerate(found[:i]):
                if alike(x, y) and not (alike(x, pivot) and alike(y, pivot)):
                    small = [{d["element"] for d in got[k] if d["small"]} for k in (i, j)]
                    large = [{d["element"] for d in got[k] if d["large"]} for k in (i, j)]
                    assert small[0] & large[1] or small[1] & large[0]
