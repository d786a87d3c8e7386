"""The trie of conversations against a plain one, and the number of rounds."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quaylake.llm import prefixtrie, queries

COLUMNS = "conv_id long, turn long, role string, text string, depth string, rep int, part string, `TOP` long"


def rows() -> list[tuple]:
    found = []
    for c in range(0, 130):
        if c in (40, 55):
            continue  # a family without its first conversation, and a gap
        for t in range(c % 6 if c % 20 else 1 + c % 7):
            said = f"word{c % 4} and  {t}" if t < 2 else f"more {c % 9}\tof {t}"
            found.append((c, t if t else None, ["user", "assistant", None][t % 3], said if c % 11 else None))
    for c in range(200, 260):  # one conversation under many ids
        found += [(c, t, "user", f"the same {t}") for t in range(3)]
    found += [(300, t, "user", "a long one " + "x" * (t % 5)) for t in range(700)]
    found += [(301, t, "user", "a long one " + "x" * (t % 5)) for t in range(650)]
    found += [(None, 1, "user", "nobody"), (7, 1, "user", "again"), (-3, 1, "user", "below"), (-3, 1, "user", "below")]
    return [(*r, "x", 1, "y", 5) for r in found]


def brute(found: list[tuple]) -> list[str]:
    own = defaultdict(list)
    for c, turn, role, text, *_ in found:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in own.items()}
    seq = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seq[c] = own.get(base, [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in sorted(seq.items()):
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    total = {key: [0, 0] for key in nodes}
    children = defaultdict(int)
    longer = {key[:-1] for key in nodes if key}
    for key, members in nodes.items():
        if key:
            children[key[:-1]] += 1
        value = (int(key not in longer), (len(members) - 1) * len(key[-1][1].split()) if key else 0)
        for d in range(len(key) + 1):
            total[key[:d]][0] += value[0]
            total[key[:d]][1] += value[1]
    out = []
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in members if len(seq[c]) == len(key))
        out.append(repr((
            min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), children[key], *total[key],
            hashlib.sha256(ends.encode()).hexdigest(),
        )))
    return sorted(out)


@pytest.mark.parametrize("small, block", [(1, 8192), (40, 50), (1024, 300), (10**6, 8192)])
def test_the_query_against_a_plain_trie(session, tmp_path, monkeypatch, small, block):
    """With all, some and no rounds of the decomposition within tasks."""
    monkeypatch.setattr(prefixtrie, "RUN", 7)
    monkeypatch.setattr(prefixtrie, "SMALL", small)
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    steps = []
    plain = prefixtrie.saved
    monkeypatch.setattr(prefixtrie, "saved", lambda df, name: steps.append(name) or plain(df, name))
    # A turn number that is used twice has no order of its own, so both turns say the same here.
    data = [r for r in rows() if r[:2] != (7, 1)] + [(7, 1, "user", "again", "x", 1, "y", 5)] * 2
    session.createDataFrame(data, COLUMNS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.QUERIES["op13_conversation_trie"](session, str(tmp_path))
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(data)
    weight = sum(eval(r)[3] for r in brute(data))
    assert steps.count("centroids") <= max(weight.bit_length() - small.bit_length(), 0) + 2  # depths reach 700


def test_turns_under_one_number_are_all_kept(session):
    data = [(1, 1, "user", text, "x", 1, "y", 5) for text in ("b", "a", "b", "c")]
    found = prefixtrie.summary(session.createDataFrame(data, COLUMNS)).collect()
    length = 4 - zlib.crc32(b"1") % 4
    assert max(r["depth"] for r in found) == length and len(found) == length + 1


def test_no_conversations(session):
    assert prefixtrie.summary(session.createDataFrame([], COLUMNS)).collect() == []
    assert prefixtrie.summary(session.createDataFrame([(None, 1, "a", "b", "x", 1, "y", 5)], COLUMNS)).collect() == []


def test_whole_components_in_one_block():
    """Random forests, among them paths and stars, against plain sums."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 60, 400):
        for reach in (1, 3, n):
            columns, values, want = [], [], []
            for tree in range(3):  # a tree's root is node 0; ids and depths of trees overlap only by depth
                up = [-1] + [max(0, i - 1 - int(rng.integers(0, reach))) for i in range(1, n)]
                depth = [5 + tree]
                for i in range(1, n):
                    depth.append(depth[up[i]] + 1)
                members = rng.integers(1, 4, n).tolist()
                weight, value = members[:], rng.integers(0, 50, n).tolist()
                total = value[:]
                for i in range(n - 1, 0, -1):
                    weight[up[i]] += weight[i]
                    total[up[i]] += total[i]
                ids = [tree * 1000 + i for i in range(n)]
                order = sorted(range(n), key=lambda i: (depth[i], ids[i]))
                columns += [(ids[0], depth[0], ids[i], depth[i], ids[max(up[i], 0)], weight[i]) for i in order]
                values += [value[i] for i in order]
                want += [total[i] for i in order]
            got = prefixtrie.within([np.array(c, np.int64) for c in zip(*columns)], [np.array(values, np.int64)])
            assert got[0].tolist() == want
