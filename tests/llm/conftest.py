"""Awkward inputs that every operator must take: nulls, empty and long texts, ties, repeated rows and
columns whose names clash with each other and with the operators' own."""

from __future__ import annotations

import random

import pytest

from quaylake.llm.common import prepared

SYLLABLES = "the er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
CLASHES = {
    "c0": "string", "C1": "int", "row": "string", "key": "int", "words": "string", "TEXT": "string", "at": "int",
    "shard": "string", "slot": "string", "kept": "int", "spans": "string", "sequence_id": "string", "fp": "long",
    "ids": "string", "quality": "string", "lines": "int", "part": "int", "size": "int", "count": "int",
}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WIDE = COLUMNS + "".join(f", `{name}` {kind}" for name, kind in CLASHES.items())


def prose(rng: random.Random, words: int) -> str:
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    for i in range(7, len(out), 11):
        out[i] += rng.choice([".", ",", ".\n"])
    return " ".join(out).replace("\n ", "\n")


def texts() -> list[str | None]:
    rng = random.Random(7)
    passage, line = prose(rng, 40).replace("\n", " "), "All rights reserved by the owners of this page."
    out: list[str | None] = [None, None, "", "", " \t\n \x0b", "?!", "Word", "two words", "é à ü ß", "日本語 テキスト"]
    for i in range(30):
        text = prose(rng, rng.randint(20, 160))
        if i % 3 == 0:
            text = f"{text} {passage} {prose(rng, 5)}"
        if i % 2 == 0:
            text = f"{text}\n{line}\n{text[:30]}"
        out.append(text)
    out += [out[12], out[12], out[12].replace("the", "teh", 1), out[15] + " more"]
    out.append(prose(rng, 30_000))
    out.append("x" * 20_000)
    out.append("spam spam " * 300)
    out.append("Mail a.b+c@mail.example.com or +1 (906) 555-4827, 10.0.0.1, 4111 1111 1111 1111; IBAN GB82WEST12345698765432")
    return out


def records() -> list[tuple]:
    langs, found = ["de", "en", None, "fr"], []
    for i, text in enumerate(texts()):
        found.append((None if i in (3, 14) else i, text, langs[i % 4], None if i % 9 == 8 else f"src{i % 8}", len(text or "")))
    found += [found[20], found[20], (None, None, None, None, None), (17, "another text under a used id", "en", "src1", 5)]
    return found


@pytest.fixture(scope="session")
def session(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return records()


@pytest.fixture(scope="session")
def awkward(session, rows):
    """The rows over several partitions, with clashing columns."""
    wide = [(*r, *[None if kind == "string" else 7 for kind in CLASHES.values()]) for r in rows]
    return session.createDataFrame(wide, WIDE).repartition(3)


@pytest.fixture(scope="session")
def empty(session):
    return session.createDataFrame([], WIDE)
