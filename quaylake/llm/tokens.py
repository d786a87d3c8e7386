"""Token ids of texts, word by word, and their pieces of bounded length."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quaylake.llm.common import picked

VOCABULARY = "word_bpe_49k.json"
END = 0
KNOWN = 400_000  # words whose ids a worker remembers
BATCH_BYTES = 16 << 20


def vocabulary_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of words without spaces, for a tokenizer that drops spaces and never joins across them.

    Lower-case ASCII letters and trailing points or commas are tokens of their own for it, so a word is
    looked up as its letters and its ending; any other word is left to the tokenizer as a whole.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.letters = self.whole.model
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, text: str) -> bytes:
        if text not in self.parts:
            if text.isalpha():
                ids = [t.id for t in self.letters.tokenize(text)]
            else:
                ids = self.whole.encode(text, add_special_tokens=False).ids
            self.parts[text] = np.array(ids, "<u4").tobytes()
        return self.parts[text]

    def word(self, word: str) -> bytes:
        if word.isascii():
            low = word.lower()
            bare = low.rstrip(".,")
            if bare.isalpha():
                return self.part(bare) + (self.part(low[len(bare):]) if len(bare) < len(low) else b"")
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        if len(self.known) + len(self.parts) > 2 * KNOWN:
            self.known, self.parts = {}, {}
        known, found = self.known, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = self.word(word)
            found.append(ids)
        return found

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with END behind it, and where each text begins."""
        plain = pc.fill_null(texts, "").cast(pa.large_string())
        for space in "\n\t":
            plain = pc.replace_substring(plain, space, " ")
        return word_by_word(plain, self.words, np.array([END], "<u4").tobytes())


def word_by_word(
    texts: pa.Array, encode: Callable[[list[str]], list[bytes]], end: bytes = b"", separator: str = " "
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each with the ids `end` behind it, and where each text begins. Texts
    are split at the separator; `encode` gives the ids of distinct words, 32-bit numbers as bytes."""
    lists = pc.split_pattern(texts, separator)
    words = lists.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = [end, *encode(words.dictionary.to_pylist())]
    counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.cumsum(counts) - counts
    pool = np.frombuffer(b"".join(ids), "<u4")
    edges = lists.offsets.to_numpy().astype(np.int64)
    edges = edges - edges[0]
    order = np.insert(codes + 1, edges[1:], 0)  # code 0 is the end
    lengths = counts[order]
    ends = np.cumsum(lengths)
    places = np.repeat(starts[order] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
    at = np.concatenate([[0], ends])[edges + np.arange(len(edges))]
    return pool[places], at


ENCODERS: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """One per worker process, kept between tasks."""
    if vocabulary not in ENCODERS:
        ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return ENCODERS[vocabulary]


def gathered(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of about `most` bytes: words repeat more in larger ones."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def pieces(
    docs: DataFrame, most: int, id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Pieces of at most `most` ids: the id, `piece` (from 0), `start`, `length` and `ids`, the ids as
    little-endian unsigned 32-bit numbers.

    A document is its ids and END; a null text counts as empty and is END alone. Only a document that
    is longer is cut, and only its last piece may be shorter. Rows with equal ids are all cut.
    """
    rows = picked(docs, id=id, text=text)
    schema = StructType([
        StructField(id, rows.schema["id"].dataType),
        *[StructField(name, LongType()) for name in ("piece", "start", "length")],
        StructField("ids", BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in gathered(batches):
            if not batch.num_rows:
                continue
            ids, at = words.texts(batch.column(1))
            lengths = np.diff(at)
            count = -(-lengths // most)
            doc = np.repeat(np.arange(len(count)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * most
            begin = at[doc] + start
            length = np.minimum(most, lengths[doc] - start)
            offsets = np.append(begin, at[-1]).astype(np.int64) * 4
            data = pa.Array.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece), pa.array(start), pa.array(length),
                 data.cast(pa.binary())],
                names=schema.names,
            )

    return rows.mapInArrow(cut, schema)
