"""Quality rules, personal data, languages and subword pieces against plain Python."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaylake.llm import language, pii, quality, subwords

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def found(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def measures(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), failed,
    )


def test_measures(awkward, rows):
    got = found(quality.judged(awkward), "doc_id", *quality.METRICS, "base_failed")
    assert got == sorted(((r[0], *measures(r[1])) for r in rows), key=repr)


def test_posterior_is_that_of_the_estimate(awkward):
    votes = quality.voted(quality.measured(awkward))
    names = list(quality.rules())
    patterns = Counter(tuple(r[f"vote_{n}"] for n in names) for r in votes.collect())
    model = quality.estimated(list(patterns.items()), names)
    got = quality.judged(awkward)
    assert quality.fitted(votes) == model
    for r in got.collect():
        assert 0 <= r["quality"] <= 1
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)
    for pattern in patterns:
        odds = math.log(model.good / (1 - model.good)) + sum(
            math.log(model.votes[n]["good"][v] / model.votes[n]["bad"][v]) for n, v in zip(names, pattern)
        )
        assert any(abs(r["quality"] - 1 / (1 + math.exp(-odds))) < 1e-9 for r in got.collect())


def test_estimate_finds_the_rules_accuracies():
    rng, truth = random.Random(1), {"a": 0.95, "b": 0.8, "c": 0.7, "d": 0.9}
    patterns: Counter = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        votes = []
        for accuracy in truth.values():
            if rng.random() < 0.1:
                votes.append(quality.ABSTAIN)
            elif good:
                votes.append(quality.GOOD if rng.random() < 0.995 else quality.BAD)
            else:
                votes.append(quality.BAD if rng.random() < accuracy else quality.GOOD)
        patterns[tuple(votes)] += 1
    model = quality.estimated(list(patterns.items()), list(truth))
    assert abs(model.good - 0.8) < 0.03
    for name, accuracy in truth.items():
        assert abs(model.votes[name]["bad"][quality.BAD] - 0.9 * accuracy) < 0.06


def test_quality_filter_keeps_columns(awkward, empty):
    kept = quality.filtered(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == quality.judged(awkward).where("kept").count() > 0
    assert quality.filtered(empty).count() == quality.judged(empty).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(figures: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(figures[::-1])) % 10 == 0


def base_spans(text: str | None) -> str:
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            figures = re.sub("[^0-9]", "", m[0])
            if {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(figures) <= 19 and luhn(figures), "phone": 10 <= len(figures) <= 15,
            }[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def odd_texts() -> list[str]:
    rng = random.Random(5)
    parts = ["a@b.c", "_d@e.f", ".", "@", "+", "1.2.3.4", "300.1.1.1", "007.1.1.1", "4111 1111 1111 1111", "-", " ", "é",
             "😀", "+1 (906) 555-4827", "5", "()", "4111-1111-1111-1112", "\n", "x", "%"]
    out = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(400)]
    return [*out, "a" * 50_000 + "@", "9" * 50_000, "a@" + "b." * 20_000, "1." * 8_000, "+1" + ")" * 50_000, ""]


def test_base_spans_are_those_of_the_plain_expressions(session, awkward, rows):
    docs = session.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string")
    want = [(i, base_spans(t)) for i, t in enumerate(odd_texts())]
    assert found(pii.detected(docs).select("doc_id", pii.as_text(F.col("base"))), "*") == sorted(want, key=repr)
    got = found(pii.detected(awkward).select("doc_id", pii.as_text(F.col("base"))), "*")
    assert got == sorted(((r[0], base_spans(r[1])) for r in rows), key=repr)


def test_checksums_and_context(session):
    cases = [
        ("iban GB82 WEST 1234 5698 7654 32 please", ["iban"]), ("GB82WEST12345698765433", []),
        ("call us by phone: (906) 555-4827", ["local_phone"]), ("number (906) 555-4827", []),
        ("ssn 123-45-6789", ["national_id"]), ("part 123-45-6789", []), ("ssn 000-45-6789", []),
        ("card 4111 1111 1111 1111", ["card"]), ("card 4111 1111 1111 1112", []),
        ("write to me@example.com", ["email"]), (None, []),
    ]
    docs = session.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r[0]: [s["kind"] for s in r[1]] for r in pii.detected(docs).select("doc_id", "spans").collect()}
    assert got == {i: kinds for i, (_, kinds) in enumerate(cases)}


def test_redaction(session, awkward, empty):
    docs = session.createDataFrame(
        [(1, "é me@a.bc, +1 (906) 555-4827!", 29), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long"
    )
    assert found(pii.redacted(docs), "*") == [(1, "é <EMAIL>, <PHONE>!", 19), (2, None, None), (3, "clean", 5)]
    assert pii.redacted(awkward).columns == awkward.columns
    assert pii.redacted(empty).count() == pii.detected(empty).count() == 0


@pytest.mark.parametrize("run", [1, 2, 3, 1024])
def test_viterbi_is_the_best_path(monkeypatch, run):
    """However short the runs into which texts are cut."""
    monkeypatch.setattr(language, "RUN", run)
    rng = np.random.default_rng(0)
    for _ in range(100):
        counts = rng.integers(1, 6, int(rng.integers(1, 6)))
        langs, penalty = int(rng.integers(1, 4)), float(rng.choice([0.5, 3, 8]))
        scores, starts = rng.normal(0, 3, (int(counts.sum()), langs)), np.cumsum(counts) - counts

        def worth(path, start):
            turns = sum(a != b for a, b in zip(path, path[1:]))
            return sum(scores[start + i, x] for i, x in enumerate(path)) - penalty * turns

        for method in (language.viterbi, language.labelled):
            labels = method(scores, starts, counts, penalty)
            for start, n in zip(starts, counts):
                best = max(worth(p, start) for p in itertools.product(range(langs), repeat=int(n)))
                assert abs(worth(labels[start:start + n], start) - best) < 1e-9


def test_a_text_of_a_million_words_takes_few_steps(monkeypatch):
    """As many as a run has words, and twice that for the labels; the labels are those of a plain search."""
    rng = np.random.default_rng(1)
    counts = np.array([1_000_000, 5000, 3])
    scores = rng.normal(0, 1, (int(counts.sum()), 4)) + 3 * np.eye(4)[np.repeat(rng.integers(0, 4, 10_051), 100)[:counts.sum()]]
    starts, steps, plain = np.cumsum(counts) - counts, [], language.forward

    def counted(*given):
        steps.append(int(given[2][0]))
        return plain(*given)

    monkeypatch.setattr(language, "forward", counted)
    labels = language.viterbi(scores, starts, counts, 12.0)
    assert sum(steps) <= 2 * language.RUN
    state, back = np.zeros(4), []
    for row in scores[:counts[0]].tolist():
        best = max(range(4), key=state.__getitem__)
        back.append([best if state[best] - 12.0 > state[x] else x for x in range(4)])
        state = [max(state[best] - 12.0, state[x]) + row[x] for x in range(4)]
    at, path = max(range(4), key=state.__getitem__), []
    for came in reversed(back):
        path.append(at)
        at = came[at]
    assert labels[:counts[0]].tolist() == path[::-1] and len(set(path)) == 4


def test_languages(session, awkward, rows, empty):
    spoken = {"en": "the house and the garden were there when they came", "el": "το σπίτι και ο κήπος ήταν εκεί",
              "fr": "la maison et le jardin étaient là quand ils sont venus", "ru": "дом и сад были там когда они пришли"}
    docs = session.createDataFrame(list(spoken.items()), "lang string, text string")
    model = language.learned(docs)
    assert model.langs == sorted(spoken)
    mixed = f"{spoken['en']}. {spoken['ru']}! {spoken['fr']}"
    tests = [*[(x, t) for x, t in spoken.items()], ("mixed", mixed), ("und", None), ("und", "12 !?"), ("ru", "ночь")]
    got = {r["name"]: r for r in language.predicted(
        session.createDataFrame(tests[:5] + tests[7:], "name string, text string"), model, name="name").collect()}
    assert all(got[x]["lang_pred"] == x for x in spoken)
    assert [s["lang"] for s in got["mixed"]["spans"]] == ["en", "ru", "fr"]
    assert mixed[got["mixed"]["spans"][1]["start"]:got["mixed"]["spans"][1]["end"]] == spoken["ru"]
    nothing = language.predicted(session.createDataFrame(tests[5:7], "name string, text string"), model, name="name")
    assert found(nothing, "lang_pred", "score") == [("und", 0.0)] * 2
    learned = language.learned(awkward)
    result = language.predicted(awkward, learned, doc_id="doc_id").collect()
    assert len(result) == len(rows)
    letters = {id(r): any(c.isalpha() for c in r[1] or "") for r in rows}
    assert sum(r["lang_pred"] == "und" for r in result) == sum(not x for x in (letters[id(r)] for r in rows))
    assert all(0 <= r["score"] <= 1 for r in result)
    untaught = language.learned(empty)
    assert untaught.langs == [] and language.predicted(empty, untaught).count() == 0
    assert {r["lang_pred"] for r in language.predicted(awkward, untaught).collect()} == {"und"}


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores in the library's own search for the best segmentation."""
    sentencepiece = pytest.importorskip("sentencepiece")
    with open(subwords.vocabulary_path(subwords.MODEL), "rb") as file:
        return sentencepiece.SentencePieceProcessor(model_proto=file.read() + bytes([0x12, 2, 0x18, 1]))


def test_segmentation_is_the_librarys(library, rows):
    words = sorted({" " + w for r in rows for w in WORD.findall(r[1] or "") if len(w) < 60})
    known = subwords.pieces(subwords.MODEL)
    spaced = [w for w in words if all(library.piece_to_id(c) != library.unk_id() for c in w[1:])]
    assert len(spaced) > 5000
    for word, ids in zip(spaced, known.words(spaced)):
        mine = np.frombuffer(ids, "<u4").tolist()
        best = library.nbest_encode(word[1:], nbest_size=2)[0]
        value = lambda ids: sum(library.get_score(i) for i in ids)
        assert mine == best or value(mine) == value(best)


def test_merges_are_the_librarys(rows):
    sentencepiece = pytest.importorskip("sentencepiece")
    bpe = sentencepiece.SentencePieceProcessor(model_file=subwords.vocabulary_path(subwords.MODEL))
    texts = [r[1] or "" for r in rows if len(r[1] or "") < 5000] + ["  two  spaces ", "日本語 テ\n\nx", "a", " ", "é̂ ", "tokenization"]
    got = subwords.pieces(subwords.MODEL).texts(pa.array(texts), merges=True)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == bpe.encode(texts)


def test_segmentation_is_the_best_of_all(rows):
    known = subwords.pieces(subwords.MODEL)
    scores = {}
    for keys, score, codes, ids in zip(known.keys, known.scores, known.codes, known.ids):
        scores |= {"".join(map(chr, c.tolist())): (float(s), int(i)) for c, s, i in zip(codes, score, ids)}
    for word in (" the", " estate", " whén", "  two", " 日本", "\nThe", " \U0001f600x"):
        text = word.replace(" ", subwords.MARK)
        best = [(0.0, [])] + [(-math.inf, [])] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - known.longest), end):
                part = text[start:end]
                if part in scores or end - start == 1:
                    score, i = scores.get(part, (known.unknown, -1))
                    ids = [i] if i >= 0 else known.bytes[list(part.encode())].tolist()
                    if best[start][0] + score > best[end][0]:
                        best[end] = (best[start][0] + score, best[start][1] + ids)
        assert np.frombuffer(known.words([word])[0], "<u4").tolist() == best[-1][1]


def test_round_trip(awkward, empty):
    docs = subwords.encoded(awkward).withColumn("back", subwords.decoder()("ids"))
    place = docs.columns.index("text")
    for r in docs.collect():
        assert r["back"] == (r[place] or "")
        assert len(r["ids"]) % 4 == 0 and (len(r["ids"]) > 0) == bool(r[place])
    assert subwords.encoded(empty).count() == 0


def test_remembered_words_are_bounded_within_a_batch(monkeypatch):
    monkeypatch.setattr(subwords, "KNOWN_BYTES", 20_000)
    known, plain = subwords.Pieces(subwords.MODEL), subwords.pieces(subwords.MODEL)
    texts = [" ".join(f"w{i * 7919 % 9973}x{i}" for i in range(k, k + 3000)) for k in range(0, 9000, 3000)]
    for merges in (False, True):
        for text in texts:
            assert known.texts(pa.array([text]), merges) == plain.texts(pa.array([text]), merges)
            assert len(known.known[merges]) < 120


def test_the_query_returns_what_the_library_has(session, rows, tmp_path):
    import hashlib
    import zlib

    import sentencepiece

    from quaylake.llm import queries

    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    bpe = sentencepiece.SentencePieceProcessor(model_file=subwords.vocabulary_path(subwords.MODEL))
    found = queries.QUERIES["op5_sentencepiece_round_trip"](session, str(tmp_path)).collect()
    merged_ids = subwords.encoded(docs, wanted=("merged_ids",)).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids, = subwords.pieces(subwords.MODEL).texts(pa.array([text], pa.string()))
        want.append((doc_id, len(ids) // 4, zlib.crc32(ids), hashlib.md5((text or "").encode()).hexdigest(), True))
    assert sorted(repr(tuple(r)) for r in found) == sorted(map(repr, want))
    whole = [(r["doc_id"], r["merged_ids"]) for r in merged_ids]
    by_merges = [(r[0], np.array(bpe.encode(r[1]), "<u4").tobytes() if r[1] else b"") for r in rows]
    assert sorted(whole, key=repr) == sorted(by_merges, key=repr)
    assert all(r["round_trip"] for r in found)


@pytest.mark.parametrize("letter", ["I", "İ", "ß", "é"])
def test_context_where_lower_case_is_longer(session, letter):
    """A letter that lowers to two moves no context away from its number."""
    text = letter * 60 + " SSN 123-45-6789"
    got = pii.detected(session.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [(s["kind"], s["start"], s["end"]) for s in got["spans"]] == [("national_id", 65, 76)]
