"""SimHash classes, line boilerplate and repeated passages against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
import xxhash

from quaylake.llm import linededup, simhash, substring
from quaylake.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def found(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def fingerprint(text: str | None) -> int:
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints: list[int], distance: int = 2) -> list[int]:
    parent = list(range(len(prints)))

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(prints))]


def test_classes(awkward, rows):
    prints = [fingerprint(r[1]) for r in rows]
    least: dict[int, int | None] = {}
    for r, root in zip(rows, roots(prints)):
        known = [x for x in (least.get(root), r[0]) if x is not None]
        least[root] = min(known, default=None)
    want = sorted(((r[0], format(p, "016x"), least[root]) for r, p, root in zip(rows, prints, roots(prints))), key=repr)
    assert found(simhash.classes(awkward), "doc_id", "fingerprint", "component_id") == want


def test_one_document_of_each_class(awkward, rows):
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    groups = defaultdict(list)
    for r, root in zip(rows, roots([fingerprint(r[1]) for r in rows])):
        groups[root].append(r[0])
    want = sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=repr)
    assert sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=repr) == want


@pytest.mark.parametrize("bucket, parts", [(0, 2), (1, 3), (32, 2)])
def test_links_lose_no_connection(session, bucket, parts):
    rng = random.Random(bucket + parts)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for centre in list(prints)[:4]:
        for _ in range(12):
            value = centre
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                value ^= 1 << bit
            prints.add(value)
    prints = sorted(prints | {0, (1 << 64) - 1, 1 << 63})
    table = session.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.linked(table, 2, parts, bucket)).collect()}
    groups = defaultdict(set)
    for p, root in zip(prints, roots(prints)):
        groups[root].add(simhash.signed(p))
    for group in groups.values():
        assert {got.get(p, p) for p in group} == {min(group)}


def test_odd_distances_are_refused(session):
    with pytest.raises(ValueError):
        simhash.linked(session.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_chains_stars_and_loops(session):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 200), (200, 205)]
    got = {r["node"]: r["root"] for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {205: 200}


def lines_kept(rows: list[tuple], sites: int) -> list[tuple]:
    spread, places = defaultdict(set), defaultdict(set)
    for i, text, _, site, _ in rows:
        for at, line in enumerate((text or "").split("\n")):
            plain = line.strip(" \t\r")
            if text is not None and len(plain) >= linededup.MIN_CHARS:
                spread[plain].add(site)
                places[plain].add((i is None, i if i is not None else 0, text, at))
    wide = {line for line, found in spread.items() if len(found) >= sites}
    out = []
    for i, text, _, _, _ in rows:
        if text is None:
            out.append((i, 0, 0, None))
            continue
        lines, kept = text.split("\n"), []
        for at, line in enumerate(lines):
            plain = line.strip(" \t\r")
            mine = (i is None, i if i is not None else 0)
            first = min((p[:2] for p in places[plain]), default=None) if plain in wide else None
            if first is None or (mine == first and at == min(p[3] for p in places[plain] if p[:2] == mine)):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_boilerplate_lines(awkward, rows):
    for sites in (3, 6):
        got = found(linededup.report(awkward, sites), "id", "n_lines", "n_removed", "kept_text")
        assert got == lines_kept(rows, sites)
    assert sum(x[2] for x in lines_kept(rows, 3)) > 5


def test_lines_replaced_in_documents(awkward):
    out = linededup.replaced(awkward, 3)
    assert out.columns == awkward.columns
    assert all(r[4] == (len(r[1]) if r[1] is not None else None) for r in out.collect())


def test_threshold_is_exact_near_the_estimate(session):
    rows = [(i, f"a line that stands on {n} sites", f"s{i % n}") for n in (39, 40, 41) for i in range(200)]
    docs = session.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    got = linededup.report(docs, 40).where("n_removed > 0").count()
    assert got == 2 * 199


def repeats(rows: list[tuple]) -> list[tuple]:
    least: dict[tuple, tuple] = {}
    order = lambda i: (i is None, i if i is not None else 0)
    texts = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    for i, words in texts:
        for k in range(len(words) - 12):
            window = tuple(words[k:k + 13])
            least[window] = min(least.get(window, order(i)), order(i))
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        for k in range(len(words) - 12):
            if least[tuple(words[k:k + 13])] < order(i):
                gone[k:k + 13] = [True] * 13
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=repr)


def test_repeated_passages(awkward, rows):
    got = found(substring.repeats_removed(awkward), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == repeats(rows)
    assert sum(x[2] for x in got) > 300


def test_random_repeats(session):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        rows.append((rng.randint(0, 40), " ".join(words), None, None, 0))
    docs = session.createDataFrame(rows, "doc_id long, text string, a string, b string, c long")
    got = found(substring.repeats_removed(docs), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == repeats(rows)


def test_empty_tables(empty):
    assert simhash.classes(empty).count() == simhash.one_of_each(empty).count() == 0
    assert linededup.report(empty).count() == substring.repeats_removed(empty).count() == 0
