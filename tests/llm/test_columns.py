"""What the registered queries return, column by column, against plain Python over a written table."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import texts

from quaylake.llm import bytebpe, packing, tokens
from quaylake.llm.queries import QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs() -> dict[int, str | None]:
    return {3 * i + 2: text for i, text in enumerate([*texts(), "1.2.3.4.5 and 256.1.1.1 or +49 (30) 1234-5678, x@y.z, 4111-1111-1111-1111"])}


@pytest.fixture(scope="module")
def folder(session, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("columns"))
    rows = [(i, text, "en", f"src{i % 4}", len(text or "")) for i, text in docs.items()]
    session.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{path}/documents.parquet")
    return path


def result(session, folder, name: str) -> dict:
    """Rows by document."""
    rows = [r.asDict() for r in QUERIES[name](session, folder).collect()]
    found = {r.pop("doc_id"): r for r in rows}
    assert len(found) == len(rows)
    return found


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1(session, folder, docs):
    found = result(session, folder, "op1_sharding")
    assert found.keys() == docs.keys()
    slots = collections.defaultdict(list)
    for i, r in found.items():
        data = (docs[i] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_op2(session, folder, docs):
    found = result(session, folder, "op2_quality_rules")
    assert found.keys() == docs.keys()
    for i, r in found.items():
        text = docs[i] or ""
        words = WORD.findall(text)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        repeated = {p + k for p in range(len(words) - 2) if windows[tuple(words[p:p + 3])] > 1 for k in range(3)}
        lines = collections.Counter(line for line in text.split("\n") if WORD.search(line))
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == sum(n - 1 for n in lines.values()) and r["n_repeat_words"] == len(repeated)
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r["kept"] and r["base_failed"])
    assert any(r["kept"] for r in found.values())


def fingerprint(text: str | None) -> int:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[p:p + 3]) for p in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op4(session, folder, docs):
    found = result(session, folder, "op4_simhash_near_duplicates")
    prints = {i: fingerprint(text) for i, text in docs.items()}
    root = {i: i for i in docs}
    for i in docs:
        for j in docs:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 2 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert found == {i: {"fingerprint": f"{prints[i]:016x}", "component_id": root[i]} for i in docs}
    assert len(set(root.values())) < len(docs)


def test_op5(session, folder, docs):
    found = result(session, folder, "op5_sentencepiece_round_trip")
    assert found.keys() == docs.keys()
    for i, r in found.items():
        text = docs[i] or ""
        assert r["round_trip"] and r["decoded_md5"] == hashlib.md5(text.encode()).hexdigest()
        assert (r["n_ids"] > 0) == (text != "")


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub(r"\D", "", s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15),
    )
    return sorted((m.start(), k, m.end()) for k, (p, fine) in enumerate(kinds) for m in re.finditer(p, text) if fine(m[0]))


def test_op6(session, folder, docs):
    found = result(session, folder, "op6_personal_data")
    assert found.keys() == docs.keys()
    names = ("email", "ip", "card", "phone")
    for i, r in found.items():
        spans = base_spans(docs[i] or "")
        listed = [f"{names[k]}:{start}:{end}" for start, k, end in spans]
        assert [r[f"n_{name}"] for name in names] == [sum(k == j for _, k, _ in spans) for j in range(4)]
        assert r["base_sha256"] == sha(",".join(listed))
        assert set(listed) <= set(r["spans"].split(",")) | ({""} if not listed else set())
    assert sum(r["n_card"] for r in found.values()) >= 2 and sum(r["n_ip"] for r in found.values()) >= 2


def test_op9(session, folder, docs):
    found = result(session, folder, "op9_substring_repeats")
    words = {i: (docs[i] or "").split() if docs[i] is None else WORD.findall(docs[i]) for i in docs}
    first: dict[tuple, int] = {}
    for i in sorted(docs):
        for p in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][p:p + 13]), i)
    expected = {}
    for i, mine in words.items():
        gone = {p + k for p in range(len(mine) - 12) if first[tuple(mine[p:p + 13])] < i for k in range(13)}
        kept = " ".join(w for p, w in enumerate(mine) if p not in gone)
        expected[i] = {"n_words": len(mine), "n_removed": len(gone), "kept_sha256": sha(kept)}
    assert found == expected and any(r["n_removed"] for r in found.values())


def test_op10(session, folder, docs):
    import tokenizers

    own = tokenizers.Tokenizer.from_file(tokens.vocabulary_path("word_bpe_49k.json"))
    rows = [r.asDict() for r in QUERIES["op10_best_fit_packing"](session, folder).collect()]
    pieces = {}
    for i, text in docs.items():
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = np.array(ids[start:start + packing.CAPACITY], "<u4")
            pieces[i, n] = (start, len(part), zlib.crc32(part.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == pieces
    assert len(rows) == len(pieces)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        ends = np.cumsum([length for _, length in sorted(held)])
        assert [at for at, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(sequences) <= -(-sum(length for _, length, _ in pieces.values()) // 2048) + 1


def test_op12(session, folder, docs):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    ranks = load_tiktoken_bpe(tokens.vocabulary_path(bytebpe.VOCABULARY))
    import public_tokenizers

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = result(session, folder, "op12_byte_bpe_round_trip")
    assert found.keys() == docs.keys()
    for i, r in found.items():
        ids = own.encode_ordinary(docs[i] or "")
        assert r == {"n_tokens": len(ids), "ids_sha256": sha(" ".join(map(str, ids))), "decoded_sha256": sha((docs[i] or "").encode())}
