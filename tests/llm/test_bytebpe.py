"""Byte-level BPE against the library for its vocabulary."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from quaylake.llm import bytebpe, queries

ALPHABETS = ["ab", "x", "th e", "ab \n", "éa ", "  \n\t　 a", "aA1!'st .,", "0123 ", "日本語 a", "\u0085\x1c \x0ba", "the re in "]


@pytest.fixture(scope="module")
def words():
    return bytebpe.vocabulary_of(bytebpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(bytebpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts() -> list[str]:
    rng = random.Random(3)
    found = ["", " ", "\n", "a", "<|endoftext|> is text", "I'll they're 'S", "a.b,c. d ,e", "x" * 5001, "ab" * 3000, "é" * 999]
    for _ in range(600):
        letters = rng.choice(ALPHABETS)
        found.append("".join(rng.choice(letters) for _ in range(rng.choice([3, 20, 90, 500]))))
    found.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50_000)))
    return found


def test_ids_are_the_librarys(words, library):
    for text, ids in zip(texts(), words.texts(pa.array(texts()))):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert words.decoded(ids) == text.encode()


def test_pieces_of_sliced_and_null_texts(words, library):
    array = pa.array(["dropped", None, "two words", "", "three words here"]).slice(1)
    assert [len(x) // 4 for x in words.texts(array)] == [0, 2, 0, 3]
    assert words.texts(pa.array([], pa.string())) == []
    assert words.texts(pa.array([None, None], pa.string())) == [b"", b""]


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_joins_hold_for_any_halving(words, library, leaf, monkeypatch):
    """With tiny leaves nearly every id comes from joins and windows."""
    monkeypatch.setattr(bytebpe, "LEAF", leaf)
    fresh = bytebpe.ByteBPE(bytebpe.VOCABULARY)
    some = [t for t in texts() if len(t) < 600]
    for text, ids in zip(some, fresh.texts(pa.array(some))):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def test_a_word_of_a_million_letters_and_a_small_memory(words, monkeypatch):
    monkeypatch.setattr(bytebpe, "KNOWN_BYTES", 1000)
    fresh = bytebpe.ByteBPE(bytebpe.VOCABULARY)
    rng = random.Random(5)
    long = "".join(rng.choice("etaoin shrdlu") for _ in range(200_000)) + "q" * 300_000
    for part in (long, long[::-1]):
        ids, = fresh.texts(pa.array([part]))
        assert fresh.decoded(ids) == part.encode()
        assert len(fresh.known) <= len(set(part.split(" "))) * 2 + 2


def test_the_query_on_awkward_documents(session, rows, tmp_path, library):
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op12_byte_bpe_round_trip"](session, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))


def test_columns_and_empty_tables(session, awkward, empty):
    found = bytebpe.encoded(awkward, wanted=("ids", "decoded"))
    assert found.columns == [c for c in awkward.columns if c != "ids"] + ["ids", "decoded"]
    plain = found.toDF(*[f"x{i}" for i in range(len(found.columns))])
    ids, decoded = f"x{len(plain.columns) - 2}", f"x{len(plain.columns) - 1}"
    for text, kept, back in plain.select("x1", decoded, bytebpe.decoder()(ids)).collect():
        assert kept == back == (text or "").encode()
    assert bytebpe.encoded(empty).count() == 0
