"""Languages of texts and of the spans within them: scripts, scores per word, Viterbi."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.llm.common import picked
from quaylake.llm.tokens import gathered

BUCKETS = 1 << 16
SMOOTHING = 0.5
PENALTY = 12.0  # what a change of language costs, in natural logarithms of probability
FOREIGN = -30.0  # what a word costs in a language that isn't written in its script
SCRIPT_SHARE = 0.01  # share of a language's letters from which it is written in a script
UNKNOWN = "und"
BATCH_BYTES = 4 << 20
BLOCK = 1 << 20
RUN = 1024  # words of a run in Viterbi's search

# First code points of blocks of scripts, in order; each goes up to the next.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0780, "Thaana"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "Bopomofo"),
    (0x3130, "Hangul"), (0x3190, "other"), (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"),
    (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x32000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_OF = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@cache
def letters() -> np.ndarray:
    """Lower-case form of every code point that is a letter, 0 for all others."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


class Words:
    """Words of a batch of texts: runs of letters, with hashed pairs and triples of letters."""

    def __init__(self, texts: list[str | None]) -> None:
        codes = [np.frombuffer((t or "").encode("utf-32-le"), "<u4") for t in texts]
        sizes = np.array([len(c) + 1 for c in codes], np.int64)
        self.begins = np.cumsum(sizes) - sizes  # of each text
        flat = np.zeros(int(sizes.sum()) + 2, np.uint32)  # a gap before each text and two at the end
        for begin, code in zip(self.begins, codes):
            flat[begin + 1:begin + 1 + len(code)] = letters()[code]
        self.at = np.flatnonzero(flat)  # places of the letters
        here = flat[self.at].astype(np.uint64)
        before, after = flat[self.at - 1].astype(np.uint64), flat[self.at + 1].astype(np.uint64)
        pair = before * np.uint64(0x9E3779B97F4A7C15) + here * np.uint64(0xC2B2AE3D27D4EB4F)
        triple = pair + (after + np.uint64(1)) * np.uint64(0x165667B19E3779F9)
        self.features = [(x ^ (x >> np.uint64(33))) % np.uint64(BUCKETS) for x in (pair, triple)]
        self.start = np.flatnonzero(before == 0)  # index of each word's first letter
        self.size = np.diff(np.append(self.start, len(self.at)))
        self.place = self.at[self.start]
        self.doc = np.searchsorted(self.begins, self.place, side="right") - 1
        self.script = SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, here[self.start], side="right") - 1]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each feature, and behind them each script, occurs by language in one partition."""
    counts: dict[str, np.ndarray] = {}
    for batch in gathered(batches, BATCH_BYTES):
        langs = np.array(batch.column("lang").to_pylist(), object)
        words = Words(batch.column("text").to_pylist())
        lang = langs[words.doc]
        for name in sorted(set(lang)):
            total = counts.setdefault(name, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
            mine = lang == name
            each = np.repeat(mine, words.size)
            for feature in words.features:
                total[:BUCKETS] += np.bincount(feature[each].astype(np.int64), minlength=BUCKETS)
            total[BUCKETS:] += np.bincount(
                words.script[mine], weights=words.size[mine], minlength=len(SCRIPT_NAMES)
            ).astype(np.int64)
    for name, total in counts.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])],
            names=["lang", "bucket", "n"],
        )


@dataclass(frozen=True)
class Model:
    langs: list[str]
    weights: np.ndarray  # by bucket and language
    written: np.ndarray  # by script and language

    def scores(self, words: Words) -> np.ndarray:
        """Of every word in every language."""
        out = np.zeros((len(words.start), len(self.langs)))
        first = 0
        while first < len(words.start):
            low = words.start[first]
            last = max(int(np.searchsorted(words.start, low + BLOCK)), first + 1)
            high = words.start[last] if last < len(words.start) else len(words.at)
            sums = sum(self.weights[f[low:high].astype(np.int64)] for f in words.features)
            out[first:last] = np.add.reduceat(sums, words.start[first:last] - low, axis=0)
            first = last
        known = self.written[words.script]
        return out + np.where(known | ~known.any(axis=1, keepdims=True), 0.0, FOREIGN)


def learned(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts all rows that have a text and a language. The driver gets one number per bucket and
    language that occurs: BUCKETS times the number of languages at most."""
    rows = picked(docs, text=text, lang=lang).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    langs = sorted(found["lang"].unique().tolist())
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    place = found["lang"].map({name: i for i, name in enumerate(langs)}).to_numpy(np.int64)
    table[found["bucket"].to_numpy(np.int64), place] = found["n"]
    features, scripts = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    weights = np.log(features) - np.log(features.sum(axis=0, keepdims=True))
    written = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    return Model(langs, weights.astype(np.float32), written)


def forward(
    scores: np.ndarray, starts: np.ndarray, counts: np.ndarray, state: np.ndarray, penalty: float, back: list | None = None
) -> np.ndarray:
    """Worth of the best paths to each language at the end of every run of words. `state` is their worth before it.
    Runs come the longest first and advance word by word together; `back` takes the languages they came from."""
    own = np.arange(scores.shape[1])
    for t in range(int(counts[0]) if len(counts) else 0):
        a = int(np.searchsorted(-counts, -t, side="left"))
        best = state[:a].argmax(axis=1)
        moved = state[np.arange(a), best][:, None] - penalty
        change = moved > state[:a]
        if back is not None:
            back.append(np.where(change, best[:, None], own).astype(np.int16))
        state[:a] = np.where(change, moved, state[:a]) + scores[starts[:a] + t]
    return state


def viterbi(scores: np.ndarray, starts: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word.

    Documents are cut into runs of RUN words, which advance together, so the longest text sets no number of steps.
    A run behind the first is passed once for each language it may be entered from; the runs of a document are then
    joined in order, each entry the one with the best sum, and only the runs on the best path are passed again for
    their labels.
    """
    langs = scores.shape[1]
    many = -(-counts // RUN)
    doc = np.repeat(np.arange(len(counts)), many)
    first = np.cumsum(many) - many  # run of each document
    number = np.arange(len(doc)) - first[doc]
    begin, size = starts[doc] + number * RUN, np.minimum(RUN, counts[doc] - number * RUN)
    entry = np.full(len(doc), -1)  # language before the run, none before the first
    leave = np.zeros(len(doc), np.int64)  # language of its last word

    later = np.flatnonzero(number)
    long = np.flatnonzero(many > 1)
    if len(later):
        run = np.concatenate([first[long], np.repeat(later, langs)])
        came = np.concatenate([np.full(len(long), -1), np.tile(np.arange(langs), len(later))])
        order = np.argsort(-size[run], kind="stable")
        found = np.empty((len(run), langs))
        found[order] = forward(scores, begin[run[order]], size[run[order]], entered(came[order], langs), penalty)
        total = found[:len(long)]
        through = found[len(long):].reshape(len(later), langs, langs)
        place = np.cumsum(number > 0) - 1  # of a run among the later ones
        source = np.zeros((len(doc), langs), np.int64)
        for k in range(1, int(many.max())):
            here = np.flatnonzero(many[long] > k)
            both = total[here][:, :, None] + through[place[first[long[here]] + k]]
            source[first[long[here]] + k] = both.argmax(axis=1)
            total[here] = both.max(axis=1)
        at = total.argmax(axis=1)
        for k in range(int(many.max()) - 1, 0, -1):
            here = np.flatnonzero(many[long] > k)
            which = first[long[here]] + k
            leave[which] = at[here]
            at[here] = entry[which] = source[which, at[here]]
        leave[first[long]] = at

    order = np.argsort(-size, kind="stable")
    back: list[np.ndarray] = []
    state = forward(scores, begin[order], size[order], entered(entry[order], langs), penalty, back)
    at = np.where(many[doc[order]] > 1, leave[order], state.argmax(axis=1) if len(state) else 0)
    labels = np.zeros(len(scores), np.int64)
    for t in range(len(back) - 1, -1, -1):
        a = len(back[t])
        labels[begin[order[:a]] + t] = at[:a]
        at[:a] = back[t][np.arange(a), at[:a]]
    return labels


def entered(came: np.ndarray, langs: int) -> np.ndarray:
    """Worth of each language before a run that is entered from one, or from none (-1)."""
    state = np.full((len(came), langs), -np.inf)
    state[came < 0] = 0.0
    inner = np.flatnonzero(came >= 0)
    state[inner, came[inner]] = 0.0
    return state


def labelled(scores: np.ndarray, starts: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """As `viterbi`, but documents where no stretch of words gains more than one change costs, whatever
    languages it had, get their best single language at once: there no path with a change is better."""
    if not len(starts):
        return np.zeros(0, np.int64)
    total = np.add.reduceat(scores, starts, axis=0)
    best = total.argmax(axis=1)
    doc = np.repeat(np.arange(len(starts)), counts)
    mine = scores[np.arange(len(scores)), best[doc]]
    rest = scores.copy()
    rest[np.arange(len(scores)), best[doc]] = -np.inf
    gain = rest.max(axis=1) - mine
    if not np.isfinite(gain).all():  # one language only
        return best[doc]
    # Largest sum of neighbouring gains: sums within the document less the lowest one before. Each
    # document's sums lie below all earlier ones, so that the running minimum starts anew with it.
    sums = np.cumsum(gain)
    sums -= (sums[starts] - gain[starts])[doc]
    level = -doc * (2 * np.abs(sums).max() + 1)
    before = np.empty(len(sums))
    before[1:] = sums[:-1]
    before[starts] = 0.0
    lowest = np.minimum.accumulate(before + level)
    most = np.maximum.reduceat(sums + level - lowest, starts)
    labels = best[doc]
    hard = np.flatnonzero(most > penalty)
    if len(hard):
        inner = np.concatenate([np.arange(starts[d], starts[d] + counts[d]) for d in hard])
        begin = np.cumsum(counts[hard]) - counts[hard]
        labels[inner] = viterbi(scores[inner], begin, counts[hard], penalty)
    return labels


def spans_of(model: Model, texts: list[str | None], penalty: float = PENALTY) -> list[list[tuple[str, int, int, int]]]:
    """For each text its spans: language, begin, end (code points) and number of letters."""
    words = Words(texts)
    out: list[list[tuple[str, int, int, int]]] = [[] for _ in texts]
    if not len(words.start) or not model.langs:
        return out
    new = np.ones(len(words.doc), bool)
    new[1:] = words.doc[1:] != words.doc[:-1]
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(words.doc)))
    labels = labelled(model.scores(words), starts, counts, penalty)
    turn = new.copy()
    turn[1:] |= labels[1:] != labels[:-1]
    first = np.flatnonzero(turn)
    last = np.append(first[1:], len(turn)) - 1
    size = np.add.reduceat(words.size, first)
    begin = words.place - words.begins[words.doc] - 1
    for f, e, n in zip(first, last, size):
        out[words.doc[f]].append((model.langs[labels[f]], int(begin[f]), int(begin[e] + words.size[e]), int(n)))
    return out


def predicted(docs: DataFrame, model: Model, text: str = "text", penalty: float = PENALTY, **carry: str) -> DataFrame:
    """One row per document with the carried columns (new name = old name), `lang_pred`, `score` and
    `spans`, an array of (lang, start, end) in code points, end exclusive.

    A word is a run of letters. Its script leaves the languages that are written in it; each scores the
    word by its pairs and triples of letters, and Viterbi's path over the words, where every change of
    language costs `penalty`, labels them. `lang_pred` has the most letters (ties: first in order of
    name), `score` is their share. A text that is null or has no letter is UNKNOWN with score 0, and so
    are all texts if nothing could be learned. Equal rows are all kept.
    """
    rows = picked(docs, **carry, text=text)
    span_type = T.ArrayType(T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))
    schema = T.StructType([
        *rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("spans", span_type),
    ])
    span = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BATCH_BYTES):
            langs, scores, spans = [], [], []
            for found in spans_of(model, batch.column("text").to_pylist(), penalty):
                share: dict[str, int] = {}
                for lang, _, _, n in found:
                    share[lang] = share.get(lang, 0) + n
                best = min(share, key=lambda x: (-share[x], x), default=UNKNOWN)
                langs.append(best)
                scores.append(share[best] / sum(share.values()) if share else 0.0)
                spans.append([{"lang": x, "start": a, "end": b} for x, a, b, _ in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "spans"],
            )

    return rows.mapInArrow(run, schema)
