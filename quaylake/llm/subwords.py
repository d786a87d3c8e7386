"""Encoding and decoding with the pieces of a SentencePiece model: batched Viterbi in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from quaylake.llm.common import carried, numbered, position
from quaylake.llm.tokens import gathered, vocabulary_path, word_by_word

MODEL = "piece_bpe_32k.model"
MARK = "▁"  # stands for a space
KNOWN_BYTES = 96 << 20  # what a worker remembers of words and their ids
ENTRY_BYTES = 200  # of a word besides its letters and ids
BATCH_BYTES = 4 << 20
CELLS = 1 << 16  # letters of words that advance together
BASE = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN_PENALTY = 10.0


def hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` code points from each place of each row on."""
    out = np.full((codes.shape[0], codes.shape[1] - length + 1), length, np.uint64)
    for j in range(length):
        out = (out ^ codes[:, j:j + out.shape[1]]) * BASE
        out ^= out >> np.uint64(29)
    return out


class Pieces:
    """Pieces and scores of a model. The best segmentation of a word is the one with the highest sum of
    scores, as in a unigram model; of equal ones the one whose last pieces are longer. A character that
    no piece covers is unknown and becomes its bytes."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(model))
        self.text: list[bytes] = []
        self.bytes = np.full(256, read.unk_id(), np.int64)
        found: list[tuple[str, float, int]] = []
        for i in range(read.get_piece_size()):
            piece = read.id_to_piece(i)
            if read.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value] = i
                self.text.append(bytes([value]))
            elif read.is_control(i) or read.is_unknown(i):
                self.text.append(b"" if read.is_control(i) else " ⁇ ".encode())
            else:
                self.text.append(piece.replace(MARK, " ").encode())
                if not read.is_unused(i):
                    found.append((piece, read.get_score(i), i))
        self.unknown = min((score for _, score, _ in found), default=0.0) - UNKNOWN_PENALTY
        if any(MARK in piece.lstrip(MARK) for piece, _, _ in found):
            raise ValueError("a piece spans words")  # words could then not be encoded one by one
        # A character in no piece stands alone in every segmentation: words may part at line breaks then.
        self.breaks = "( +)" if any("\n" in piece for piece, _, _ in found) else "( +|\n)"
        self.longest = max(len(piece) for piece, _, _ in found)
        self.keys, self.scores, self.ids, self.codes = [], [], [], []
        for length in range(1, self.longest + 1):
            mine = [x for x in found if len(x[0]) == length]
            codes = np.array([[ord(c) for c in x[0]] for x in mine], np.uint64).reshape(len(mine), length)
            key = hashes(codes, length)[:, 0] if mine else np.zeros(0, np.uint64)
            order = np.argsort(key)
            self.keys.append(key[order])
            self.codes.append(codes[order])
            self.scores.append(np.array([x[1] for x in mine])[order])
            self.ids.append(np.array([x[2] for x in mine], np.int64)[order])
        self.known: list[dict[str, bytes]] = [{}, {}]
        self.held = [0, 0]

    def probed(self, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece at each place of each row; -inf where there is none."""
        keys = self.keys[length - 1]
        shape = (codes.shape[0], codes.shape[1] - length + 1)
        score, ids = np.full(shape, -np.inf), np.full(shape, -1, np.int64)
        if len(keys):
            wanted = hashes(codes, length).ravel()
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == wanted)
            row, place = np.divmod(hit, shape[1])
            same = np.ones(len(hit), bool)
            for j in range(length):
                same &= self.codes[length - 1][at[hit], j] == codes[row, place + j]
            hit = hit[same]
            score.ravel()[hit] = self.scores[length - 1][at[hit]]
            ids.ravel()[hit] = self.ids[length - 1][at[hit]]
        if length == 1:
            score[ids < 0] = self.unknown
        return score, ids

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of all pieces in words of one length, by word, end and start: column k of
        `most` starts most - k places before the end. Where no piece is, -inf and -1."""
        size, most = len(words[0]), min(self.longest, len(words[0]))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), size).astype(np.uint64)
        score = np.full((len(words), size + 1, most), -np.inf)
        piece = np.full((len(words), size + 1, most), -1, np.int32)
        for length in range(1, most + 1):
            s, i = self.probed(codes, length)
            score[:, length:, most - length], piece[:, length:, most - length] = s, i
        return score, piece

    def segmented(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length on the best path: all words advance by one end at a time."""
        score, piece = self.lattice(words)
        size, most = len(words[0]), score.shape[2]
        best = np.full((len(words), most + size + 1), -np.inf)
        best[:, most] = 0.0
        back = np.zeros((len(words), size + 1), np.int32)
        every = np.arange(len(words))
        for end in range(1, size + 1):
            paths = best[:, end:end + most] + score[:, end]
            back[:, end] = paths.argmax(axis=1)  # the first: the longest last piece
            best[:, most + end] = paths[every, back[:, end]]
        found: list[list[int]] = [[] for _ in words]
        end = np.full(len(words), size)
        while len(every):
            k = back[every, end]
            ids, start = piece[every, end, k], end - (most - k)
            for w, i, s in zip(every.tolist(), ids.tolist(), start.tolist()):
                if i < 0:
                    found[w] += self.bytes[list(words[w][s].encode())][::-1].tolist()
                else:
                    found[w].append(i)
            open_ = start > 0
            every, end = every[open_], start[open_]
        return [np.array(ids[::-1], "<u4").tobytes() for ids in found]

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length by merges, as a model made for them is used: the two neighbours that
        make the piece with the highest score become one, the first among equals, until none is left.
        Each step takes one boundary out of every word that goes on, so their rows stay equally long."""
        score, piece = self.lattice(words)
        size, most = len(words[0]), score.shape[2]
        every = np.arange(len(words))
        bounds = np.tile(np.arange(size + 1), (len(words), 1))
        found: list[bytes] = [b""] * len(words)
        while len(every):
            length = bounds[:, 2:] - bounds[:, :-2]
            value = score[every[:, None], bounds[:, 2:], np.maximum(most - length, 0)]
            value[length > most] = -np.inf
            first = value.argmax(axis=1) if value.shape[1] else np.zeros(len(every), np.int64)
            top = value[np.arange(len(every)), first] if value.shape[1] else np.full(len(every), -np.inf)
            for row in np.flatnonzero(top == -np.inf):
                word, ids = every[row], []
                for start, end in zip(bounds[row, :-1], bounds[row, 1:]):
                    i = piece[word, end, most - (end - start)]
                    ids += [i] if i >= 0 else self.bytes[list(words[word][start].encode())].tolist()
                found[word] = np.array(ids, "<u4").tobytes()
            on = np.flatnonzero(top > -np.inf)
            keep = np.ones((len(on), bounds.shape[1]), bool)
            keep[np.arange(len(on)), first[on] + 1] = False
            every, bounds = every[on], bounds[on][keep].reshape(len(on), bounds.shape[1] - 1)
        return found

    def words(self, words: list[str], merges: bool = False) -> list[bytes]:
        """Ids of words with the spaces or the line break before them. Words are remembered up to KNOWN_BYTES,
        also within a batch; then a new memory begins."""
        if self.held[merges] > KNOWN_BYTES:
            self.known[merges], self.held[merges] = {}, 0
        known, method = self.known[merges], self.merged if merges else self.segmented
        found = [known.get(word) if word else b"" for word in words]
        by_size: dict[int, list[int]] = {}
        for i, ids in enumerate(found):
            if ids is None:
                by_size.setdefault(len(words[i]), []).append(i)
        for size, group in by_size.items():
            step = max(1, CELLS // size)
            for low in range(0, len(group), step):
                part = group[low:low + step]
                for i, ids in zip(part, method([words[i].replace(" ", MARK) for i in part])):
                    found[i] = ids
                    if self.held[merges] <= KNOWN_BYTES:
                        known[words[i]] = ids
                        self.held[merges] += 4 * size + len(ids) + ENTRY_BYTES
        return found

    def texts(self, texts: pa.Array, merges: bool = False) -> list[bytes]:
        """Ids of whole texts: words with the spaces before them, one more before each text."""
        plain = pc.fill_null(texts, "").cast(pa.large_string())
        absent = next(c for c in map(chr, range(1, 0xD800)) if not pc.any(pc.match_substring(plain, c)).as_py())
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), plain, pa.scalar("", pa.large_string()))
        parted = pc.replace_substring_regex(spaced, self.breaks, f"{absent}\\1")
        ids, at = word_by_word(parted, lambda words: self.words(words, merges), separator=absent)
        data, empty = ids.tobytes(), pc.equal(pc.binary_length(plain), 0).to_pylist()
        return [b"" if none else data[4 * a:4 * b] for a, b, none in zip(at, at[1:], empty)]

    def decoded(self, ids: bytes) -> str:
        text = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text.removeprefix(b" ").decode(errors="replace")


@cache
def pieces(model: str) -> Pieces:
    """One per worker process, kept between tasks."""
    return Pieces(model)


FOUND = {"ids": BinaryType(), "merged_ids": BinaryType(), "decoded": StringType()}


def encoded(docs: DataFrame, text: str = "text", model: str = MODEL, wanted: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Adds the wanted ones of `ids`, `merged_ids` (both little-endian unsigned 32-bit numbers) and `decoded`
    (the text of `ids`).

    The segmentation of `ids` is the one with the highest sum of scores, as for a unigram model. `merged_ids`
    merges instead, which gives the ids that the library has for a BPE model.

    Text counts as it is (no normalisation), a space becomes the mark and one stands before the text. A
    null or empty text has no ids; a text of any length is encoded whole. Equal rows are all kept, an input
    column with the name of a wanted one is replaced, an empty table gives an empty result. One worker does all
    of it in small batches and remembers a bounded number of bytes.
    """
    rows, place = numbered(docs), position(docs, text)
    schema = StructType([*rows.schema.fields, *[StructField(name, FOUND[name]) for name in wanted]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BATCH_BYTES):
            own, column = pieces(model), batch.column(place)
            ids = own.texts(column) if {"ids", "decoded"} & set(wanted) else []
            made = {
                "ids": lambda: pa.array(ids, pa.binary()),
                "merged_ids": lambda: pa.array(own.texts(column, merges=True), pa.binary()),
                "decoded": lambda: pa.array(map(own.decoded, ids), pa.string()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *[made[name]() for name in wanted]], names=schema.names)

    return carried(docs, rows.mapInArrow(encode, schema), list(wanted))


def decoder(model: str = MODEL):
    """Function of a column of ids as `encoded` gives them: the text. Null stays null, bytes that are no
    UTF-8 become replacement characters, control pieces nothing."""

    @F.arrow_udf(StringType())
    def decode(ids: pa.Array) -> pa.Array:
        own = pieces(model)
        return pa.array([None if value is None else own.decoded(value) for value in ids.to_pylist()], pa.string())

    return decode


def n_ids(ids: Column) -> Column:
    return F.shiftright(F.octet_length(ids), 2).cast("long")
