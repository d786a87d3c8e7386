"""Byte-level BPE: halves are encoded on their own and joined, decoding concatenates up the same tree.

Token sequences with this join are a monoid. A sequence is the encoding of its bytes exactly if every two
neighbours in it are the encoding of their own bytes: merges go by rank and from the left, so up to the first
merge that crosses a border both sides go on as they would alone, and that merge would also happen with the
two neighbours alone. So when two encodings meet, only tokens round the border can change. A window round it is
encoded anew, and it is settled as soon as its outermost tokens come out as they went in: these had their outer
neighbours before. Otherwise it grows on that side, at last to the whole side.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from quaylake.llm.common import carried, numbered, position
from quaylake.llm.tokens import gathered, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
BATCH_BYTES = 2 << 20
KNOWN_BYTES = 64 << 20  # what a worker remembers of pieces of text
ENTRY_BYTES = 200  # of an entry besides its bytes
LEAF = 16  # bytes of words that are not halved
STEP = 1 << 14  # short words that advance together
BLOCK = 4096  # tokens that are concatenated at once
NONE = np.int64(1 << 40)  # in place of a rank


class Pairs:
    """Which neighbours make a token: the rank of what two ids are together, NONE where that is no token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        found = {
            ranks[token[:k]] << 32 | ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([*(found[k] for k in self.keys.tolist()), NONE], np.int64)
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)


class ByteBPE:
    """Ranks of a vocabulary, with the encoding of words and texts and the way back."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        import regex

        with open(vocabulary_path(vocabulary), "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.decimals = [str(i) for i in range(len(self.tokens))]
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs = Pairs(self.ranks)
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def leaves(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The encodings of short words by their definition: of all neighbours that are a token together,
        those with the lowest rank become one, the first among equals, until there are none. Words of one
        length advance together; each step takes one id from every word that goes on."""
        found: dict[bytes, bytes] = {}
        by_size: dict[int, list[bytes]] = {}
        for word in words:
            by_size.setdefault(len(word), []).append(word)
        for size, group in by_size.items():
            for low in range(0, len(group), STEP):
                part = group[low:low + STEP]
                ids = self.bytes[np.frombuffer(b"".join(part), np.uint8).reshape(len(part), size)]
                rank = self.pairs(ids[:, :-1], ids[:, 1:])
                rank = np.pad(rank, ((0, 0), (0, 1)), constant_values=NONE)  # the last has no neighbour
                own = np.arange(len(part))
                while len(own):
                    first = rank.argmin(axis=1)
                    new = rank[np.arange(len(own)), first]
                    done = np.flatnonzero(new == NONE)
                    width = 4 * ids.shape[1]
                    data = ids[done].astype("<u4").tobytes()
                    found.update((part[k], data[i * width:(i + 1) * width]) for i, k in enumerate(own[done].tolist()))
                    on = np.flatnonzero(new != NONE)
                    own, first, new, row = own[on], first[on], new[on], np.arange(len(on))
                    keep = np.ones((len(on), ids.shape[1]), bool)
                    keep[row, first + 1] = False
                    shape = (len(on), ids.shape[1] - 1)
                    ids, rank = ids[on][keep].reshape(shape), rank[on][keep].reshape(shape)
                    ids[row, first], rank[row, first] = new, NONE
                    left, right = np.flatnonzero(first > 0), np.flatnonzero(first < shape[1] - 1)
                    rank[left, first[left] - 1] = self.pairs(ids[left, first[left] - 1], new[left])
                    rank[right, first[right]] = self.pairs(new[right], ids[right, first[right] + 1])
        return found

    def merged(self, data: bytes) -> bytes:
        """The same for one word of any length, with the neighbours in a heap."""
        ranks, n = self.ranks, len(data)
        part = [data[i:i + 1] for i in range(n)]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = [(ranks[data[i:i + 2]], i, 2) for i in range(n - 1) if data[i:i + 2] in ranks]
        heapq.heapify(waiting)

        def meet(i: int, j: int) -> None:
            both = part[i] + part[j]
            if both in ranks:
                heapq.heappush(waiting, (ranks[both], i, len(both)))

        while waiting:
            _, i, size = heapq.heappop(waiting)
            j = after[i] if part[i] else n
            if j >= n or len(part[i]) + len(part[j]) != size:
                continue  # one of the two was merged in the meantime
            part[i], part[j] = part[i] + part[j], b""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                meet(i, after[i])
            if before[i] >= 0:
                meet(before[i], i)
        return np.array([ranks[p] for p in part if p], "<u4").tobytes()

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join([self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def joined(self, both: list[tuple[bytes, bytes]]) -> list[bytes]:
        """The encodings of the bytes of two encodings each: the window round the border is encoded anew and
        grows until its outermost ids stay, on a side that is used up they need not."""
        result: list[bytes] = [b""] * len(both)
        reach = [(1, 1)] * len(both)
        open_ = list(range(len(both)))
        while open_:
            windows = [
                self.bytes_of(both[k][0][-4 * reach[k][0]:]) + self.bytes_of(both[k][1][:4 * reach[k][1]]) for k in open_
            ]
            found = self.leaves(list({w for w in windows if len(w) <= LEAF}))
            again = []
            for k, window in zip(open_, windows):
                (left, right), (i, j) = both[k], reach[k]
                ids = found[window] if len(window) <= LEAF else self.merged(window)
                steady_left = 4 * i >= len(left) or ids[:4] == left[-4 * i:len(left) - 4 * i + 4]
                steady_right = 4 * j >= len(right) or ids[-4:] == right[4 * j - 4:4 * j]
                if steady_left and steady_right:
                    result[k] = left[:max(len(left) - 4 * i, 0)] + ids + right[4 * j:]
                else:
                    reach[k] = (i if steady_left else 2 * i, j if steady_right else 2 * j)
                    again.append(k)
            open_ = again
        return result

    def encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The encodings of distinct words that are not empty: leaves at once, longer words by the encodings
        of their halves, all words of a level together."""
        found = self.leaves([w for w in words if len(w) <= LEAF])
        long = [w for w in words if len(w) > LEAF]
        if long:
            halves = [(w[:len(w) // 2], w[len(w) // 2:]) for w in long]
            part = self.encoded(list({half for both in halves for half in both}))
            found.update(zip(long, self.joined([(part[a], part[b]) for a, b in halves])))
        return found

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces of text, in the order of their words."""
        if self.held > KNOWN_BYTES:
            self.known, self.held = {}, 0
        known = self.known
        plain, mixed = [], {}
        for piece in pieces:
            if piece not in known:
                if piece.isalpha() or piece[:1] == b" " and piece[1:].isalpha():  # ASCII letters alone are a word
                    plain.append(piece)
                else:
                    mixed[piece] = [w.encode() for w in self.words(piece.decode(errors="replace"))]
        found = self.encoded(list({*plain, *(w for words in mixed.values() for w in words)}))
        for piece in plain:
            known[piece] = found[piece]
            self.held += len(piece) + len(found[piece]) + ENTRY_BYTES
        for piece, words in mixed.items():
            known[piece] = b"".join([found[w] for w in words])
            self.held += len(piece) + len(known[piece]) + ENTRY_BYTES
        return [known[p] for p in pieces]

    def texts(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. No word reaches over the border of two pieces, so a text is the
        concatenation of its pieces, and equal pieces are encoded once."""
        data, ends = packed(texts)
        cuts = borders(data, ends)
        offsets = pa.py_buffer(np.concatenate([cuts, [len(data)]]).astype(np.int64).tobytes())
        pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, offsets, pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        codes = pieces.indices.to_pylist()
        found = self.pieces(pieces.dictionary.to_pylist())
        places = np.searchsorted(cuts, np.concatenate([[0], ends])).tolist()
        return [b"".join([found[c] for c in codes[low:high]]) for low, high in zip(places, places[1:])]

    def listed(self, ids: bytes) -> str:
        """Ids in decimals, with spaces between."""
        return " ".join([self.decimals[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def decoded(self, ids: bytes) -> bytes:
        """The bytes of ids: both halves' bytes, concatenated."""
        if len(ids) <= 4 * BLOCK:
            return self.bytes_of(ids)
        half = len(ids) // 8 * 4
        return self.decoded(ids[:half]) + self.decoded(ids[half:])


def packed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the texts' ends; null counts as empty."""
    plain = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    ends = np.frombuffer(offsets, np.int64)[plain.offset:plain.offset + len(plain) + 1]
    found = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data and len(ends) > 1 else np.zeros(0, np.uint8)
    return found, ends[1:] - ends[:1]


def borders(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin: every text, and within it a space or line break that stands alone between two
    characters that are surely no white space. A space goes with what follows, a line break is a piece. A
    point or comma after an ASCII letter also begins a piece, because no word holds both.

    Surely none are visible ASCII characters and those with two bytes from U+00C0 on; round any other
    character the text isn't cut, which changes nothing but the length of a piece.
    """
    start = np.zeros(len(data) + 1, bool)
    start[ends[:-1]] = True
    start[:1] = True
    if len(data) > 2:
        inside = np.flatnonzero((data[1:-1] == 32) | (data[1:-1] == 10)) + 1
        after, before, lead = data[inside + 1], data[inside - 1], data[np.maximum(inside - 2, 0)]
        visible = (after > 32) & (after < 127) | (after >= 0xC3) & (after <= 0xDF)
        visible &= (before > 32) & (before < 127) | (before >= 128) & (lead >= 0xC3) & (lead <= 0xDF)
        inside = inside[visible & ~start[inside] & ~start[inside + 1]]
        start[inside] = True
        start[inside[data[inside] == 10] + 1] = True
        stops = np.flatnonzero((data[1:] == 46) | (data[1:] == 44)) + 1
        before = data[stops - 1] | 32
        start[stops[(before >= 97) & (before <= 122)]] = True
    return np.flatnonzero(start[:-1])


@cache
def vocabulary_of(name: str) -> ByteBPE:
    """One per worker process, kept between tasks."""
    return ByteBPE(name)


FOUND = {"ids": BinaryType(), "id_text": StringType(), "decoded": BinaryType()}
KINDS = {"ids": pa.binary(), "id_text": pa.string(), "decoded": pa.binary()}


def encoded(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, wanted: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Adds the wanted ones of `ids` (little-endian unsigned 32-bit numbers), `id_text` (the same in decimals
    with spaces between) and `decoded` (the bytes that the ids stand for, which are those of the text).

    Each match of the tokenizers' pattern is encoded by itself; strings of special tokens are ordinary text. A
    null or empty text has no ids: the columns are then empty and not null. A text of any length is encoded
    whole, also one without any space. Equal rows are all kept, an input column with the name of a wanted one
    is replaced, an empty table gives an empty result. One worker does all of it, in batches of BATCH_BYTES.
    """
    rows, place = numbered(docs), position(docs, text)
    schema = StructType([*rows.schema.fields, *[StructField(name, FOUND[name]) for name in wanted]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(vocabulary)
        for batch in gathered(batches, BATCH_BYTES):
            found = words.texts(batch.column(place))
            made = {"ids": lambda ids: ids, "id_text": words.listed, "decoded": words.decoded}
            added = [pa.array(map(made[name], found), KINDS[name]) for name in wanted]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return carried(docs, rows.mapInArrow(encode, schema), list(wanted))


def decoder(vocabulary: str = VOCABULARY):
    """Function of a column of ids as `encoded` gives them: their bytes. Null stays null."""
    @F.arrow_udf(BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        words = vocabulary_of(vocabulary)
        return pa.array([None if x is None else words.decoded(x) for x in ids.to_pylist()], pa.binary())

    return decode
